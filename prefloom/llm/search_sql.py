"""The ranked lexical search as SQL."""

_LETTERS = "abcdefghijklmnopqrstuvwxyz"


def _terms(text: str) -> str:
    return rf"regexp_extract_all(translate({text}, '{_LETTERS.upper()}', '{_LETTERS}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


SEARCH_SQL = f"""WITH d AS MATERIALIZED (SELECT doc_id, {_terms('text')} AS t FROM documents WHERE len({_terms('text')}) > 0),
c AS (SELECT count(*)::BIGINT AS docs, sum(len(t))::BIGINT AS terms FROM d),
q AS (SELECT DISTINCT item_id, unnest({_terms('text')}) AS term FROM benchmark),
f AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM d) SEMI JOIN q USING (term) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight FROM f, c GROUP BY term),
m AS (SELECT doc_id, 10 + (90 * len(t) * docs) // terms AS m FROM d, c),
s AS (SELECT item_id, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM q JOIN f USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY ALL),
r AS (SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10"""
