"""Secrets in whole texts: one automaton for all rules marks the stretches that hold any, and exact rules give their spans."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from prefloom.llm.automaton import Automaton
from prefloom.llm.batches import give_back
from prefloom.llm.words import text_bytes


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(_any_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
_VALUE = "[A-Za-z0-9+/_.=-]"


@dataclass(frozen=True)
class Rule:
    """``pattern`` gives the leftmost spans that do not overlap; those whose ``group`` is under ``least`` characters are dropped.

    ``needed`` occurs in every span that stays: this is what the automaton looks for. Rules are ASCII without negated sets.
    """

    kind: str
    pattern: str
    needed: str
    group: int = 0
    least: int = 0


BASE = (
    Rule("assign", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?({_VALUE}+)""", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?{_VALUE}{{6}}""", 2, 6),
    Rule("access", "AKIA[A-Z0-9]+", "AKIA[A-Z0-9]{16}", 0, 20),
    Rule("hex", "[0-9a-f]+", "[0-9a-f]{24}", 0, 24),
)
MORE = (
    Rule("code_host", "gh[opsu]_[A-Za-z0-9]+", "gh[opsu]_", 0, 34),
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----", " PRIVATE KEY-"),
)
RULES = (*BASE, *MORE)
SPANS = "array<struct<kind string, start long, end long>>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
_SLICE = 4 << 20


class Scanner:
    def __init__(self, rules: tuple[Rule, ...]) -> None:
        self.rules = rules
        self.automaton = Automaton([r.needed for r in rules])
        self.exact = [re.compile(r.pattern.encode()) for r in rules]
        self.shortest = min(P.getwidth()[0] for P in map(re._parser.parse, (r.needed for r in rules)))

    def spans(self, column: pa.Array) -> list[list[tuple[str, int, int]]]:
        """For each text its spans (kind, first code point, code point behind), by start and then in the order of the rules."""
        raw, offsets = text_bytes(column)
        found: list[list] = [[] for _ in range(len(offsets) - 1)]
        i = 0
        while i < len(found):
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + _SLICE, "right")) - 1)
            self._slice(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], found, i)
            i = j
        return found

    def _slice(self, raw: np.ndarray, offsets: np.ndarray, found: list, first: int) -> None:
        """A pattern never reaches over a cutting byte, so the stretches between them are scanned on their own."""
        borders = np.unique(np.concatenate([np.flatnonzero(self.automaton.cuts[raw]), offsets]))
        starts, ends = np.concatenate([[0], borders]), np.concatenate([borders, [len(raw)]])
        starts, ends = starts[ends - starts >= self.shortest], ends[ends - starts >= self.shortest]
        marks = self.automaton.scan(raw, starts, ends)
        hits = np.flatnonzero(marks)
        if not len(hits):
            return
        letters = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        for k, text in zip(hits.tolist(), (np.searchsorted(offsets, starts[hits], "right") - 1).tolist()):
            # the cutting byte at the start of a stretch belongs to no pattern
            at, piece = int(starts[k]), raw[starts[k]:ends[k]].tobytes()
            base = letters[offsets[text]]
            own = found[first + text]
            for rule, exact in zip(self.rules, self.exact):
                for m in exact.finditer(piece):
                    if m.end(rule.group) - m.start(rule.group) >= rule.least:
                        own.append((rule.kind, int(letters[at + m.start()] - base), int(letters[at + m.end()] - base)))
        order = {r.kind: n for n, r in enumerate(self.rules)}
        for text in set((np.searchsorted(offsets, starts[hits], "right") - 1).tolist()):
            found[first + text].sort(key=lambda s: (s[1], order[s[0]]))


@lru_cache(4)
def _scanner(rules: tuple[Rule, ...]) -> Scanner:
    """Built once by the driver and sent to the tasks; its size depends on the rules alone."""
    return Scanner(rules)


def find_secrets(df: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, spans array<struct<kind, start, end>>)`` for every row, spans in code points, end exclusive, by start and rule.

    Only the key and the text are read. Null and empty texts have an empty list; repeated rows and keys are kept; an empty table
    gives no rows. Whole texts are scanned, in slices of whole texts, so memory is bounded by the longest text.
    """
    scanner = df.sparkSession.sparkContext.broadcast(_scanner(rules))

    def run(batches):
        for batch in batches:
            spans = scanner.value.spans(batch.column(1))
            yield pa.record_batch([batch.column(0), pa.array([[dict(zip(("kind", "start", "end"), s)) for s in own] for own in spans], _SPANS)],
                                  names=["key", "spans"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, spans {SPANS}").withColumnRenamed("key", key)


def without_spans(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with each stretch covered by spans replaced by ``<kind>`` of its first span."""
    out, at, end = [], 0, -1
    for kind, start, stop in spans:
        if start >= end:
            out += [text[at:start], f"<{kind}>"]
        at = end = max(end, stop)
    return "".join([*out, text[at:]])


def _redacted(batch: pa.RecordBatch, at: int, spans: list[list[tuple[str, int, int]]]) -> pa.RecordBatch:
    """The batch with the spans of the texts in column ``at`` replaced."""
    column = batch.column(at)
    hit = np.array([bool(own) for own in spans])
    masked = [without_spans(t, own) for t, own in zip(column.filter(pa.array(hit)).to_pylist(), filter(None, spans))]
    texts = pc.replace_with_mask(column, pa.array(hit), pa.array(masked, column.type))
    return pa.RecordBatch.from_arrays([texts if k == at else c for k, c in enumerate(batch.columns)], schema=batch.schema)


def redact_secrets(df: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """``df``, all columns kept, with every secret in ``text`` replaced by its kind in angle brackets; null texts stay null."""
    at = df.columns.index(text)
    scanner = df.sparkSession.sparkContext.broadcast(_scanner(rules))

    def run(batches):
        for batch in batches:
            # in short runs: of a run only the texts with secrets become Python strings
            for k in range(0, batch.num_rows, 500):
                part = batch.slice(k, 500)
                spans = scanner.value.spans(part.column(at))
                yield _redacted(part, at, spans) if any(spans) else part
                give_back()

    return df.mapInArrow(run, df.schema)


def span_list(spans: Column | str) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    spans = F.col(spans) if isinstance(spans, str) else spans
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
