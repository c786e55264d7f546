"""Byte-pair encoding with word ends: speculative encoding, decoding, and token counts by whole-token look-up.

The vocabulary file holds merge rules, a word-end mark and special strings; its path is a parameter. Texts are put into
composed form (NFC), lower-cased letter by letter, and cut at white space; the pieces of a cut are encoded one by one. Special
strings in a text are found first and kept as their ids. Null texts count as empty.

*Encoding* proposes, for all new pieces of a batch, the greedy longest matches. A sequence of tokens is what merging yields
exactly if no merge rule ever crosses a border, which depends on the two tokens at that border alone; so all adjacent pairs
are tested together by array look-ups, and only the pieces with a failing pair are merged step by step.

*Counting* first proves, from the rules alone, which vocabulary strings encode as one token, and counts pieces that are
among them as one; only the other pieces are merged.
"""

from __future__ import annotations

import heapq
import hashlib
import json
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from prefloom.llm.batches import give_back

#: The cut of the vocabulary's tokenizer, a fixed value of its file.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")
END = "</w>"
#: str.split() also cuts at these four, which are no white space to the tokenizer.
_NO_BLANKS = regex.compile("[\x1c-\x1f]")
_BLANKS = regex.compile(r"\p{White_Space}+")
#: Entries of a worker's look-up tables; beyond, they start anew (results do not depend on it).
CACHE_ENTRIES = 1 << 16
NEVER = np.int32(2**31 - 1)
#: Pieces up to so many bytes are merged together in tables of so many rows, longer ones alone.
TABLE_BYTES, TABLE_ROWS = 40, 20_000


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable bytes stand for themselves."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return [chr(b) if b in printable else chr(256 + others.index(b)) for b in range(256)]


class Vocabulary:
    """Tokens, merge rules and the tables derived from them; bounded by the vocabulary file, so it may be sent to all tasks."""

    def __init__(self, definition: str) -> None:
        self.name = hashlib.sha256(definition.encode()).hexdigest()
        spec = json.loads(definition)
        ids, rules = spec["model"]["vocab"], [r if isinstance(r, list) else r.split(" ") for r in spec["model"]["merges"]]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*ids.values(), *self.special.values()]) + 1
        self.tokens = [""] * size
        for token, i in [*ids.items(), *self.special.items()]:
            self.tokens[i] = token
        letters = byte_letters()
        self.inner_unit = [ids[x] for x in letters]
        self.final_unit = [ids[x + END] for x in letters]
        value = {x: b for b, x in enumerate(letters)}
        self.inner: dict[bytes, int] = {}
        self.final: dict[bytes, int] = {}
        for token, i in ids.items():
            ends = token.endswith(END) and token != END
            (self.final if ends else self.inner)[bytes(value[x] for x in token[:-len(END) if ends else None])] = i
        self._steps: dict = {}
        for piece, i in self.inner.items():
            node = self._steps
            for b in piece:
                node = node.setdefault(b, {})
            node[-1] = i
        self._inner_units, self._final_units = np.array(self.inner_unit, np.int32), np.array(self.final_unit, np.int32)
        left, right, rank = (np.full(size, -1, np.int32) for _ in range(3))
        self.rules: dict[tuple[int, int], tuple[int, int]] = {}
        for n, (a, b) in enumerate(rules):
            made = ids[a + b]
            left[made], right[made], rank[made] = ids[a], ids[b], n
            self.rules[ids[a], ids[b]] = n, made
        self._made = np.array([ids[a + b] for a, b in rules], np.int32)
        self.size, self._rank, self._left, self._right = size, rank, left, right
        self._pairs = np.array(sorted(a * size + b for a, b in self.rules), np.int64)
        self._pair_rank = np.array([self.rules[k // size, k % size][0] for k in self._pairs.tolist()], np.int32)
        self._last = self._spine(right, rank)
        self._first = self._spine(left, rank)
        self.whole = self._whole_tokens()

    @staticmethod
    def _spine(child: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every token the tokens that stand at one of its ends while it is put together, and the rule that ends each."""
        tokens, ended = [np.arange(len(child), dtype=np.int32)], [np.full(len(child), NEVER)]
        while (tokens[-1] >= 0).any():
            at = tokens[-1]
            tokens.append(np.where(at >= 0, child[at], -1).astype(np.int32))
            ended.append(np.where(at >= 0, rank[at], -1).astype(np.int32))
        return np.stack(tokens[:-1]), np.stack(ended[:-1])

    def compatible(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """For each pair of neighbouring tokens: no rule (with ``before``: none earlier than that one) crosses their border.

        A crossing rule must find its left part at the border before that is merged on, and its right part no later: of equal
        rules the left one is applied first.
        """
        good = np.ones(len(a), bool)
        (last, last_end), (first, first_end) = self._last, self._first
        for i in range(len(last)):
            x = last[i][a]
            some = np.flatnonzero((x >= 0) & good)
            if not len(some):
                break
            for j in range(len(first)):
                y = first[j][b[some]]
                some, y = some[y >= 0], y[y >= 0]
                if not len(some):
                    break
                key = x[some].astype(np.int64) * self.size + y
                at = np.minimum(np.searchsorted(self._pairs, key), len(self._pairs) - 1)
                rule = np.where(self._pairs[at] == key, self._pair_rank[at], NEVER)
                limit = NEVER if before is None else before[some]
                good[some[(rule < NEVER) & (rule < last_end[i][a[some]]) & (rule <= first_end[j][b[some]]) & (rule < limit)]] = False
        return good

    def _whole_tokens(self) -> np.ndarray:
        """Which tokens their own string encodes to: both parts do, and no earlier rule crosses the border between them."""
        made = np.flatnonzero(self._rank >= 0)
        made = made[np.argsort(self._rank[made])]
        fits = self.compatible(self._left[made], self._right[made], self._rank[made])
        whole = np.zeros(self.size, bool)
        whole[self.inner_unit] = whole[self.final_unit] = True
        for token, a, b, fit in zip(made.tolist(), self._left[made].tolist(), self._right[made].tolist(), fits.tolist()):
            whole[token] = fit and whole[a] and whole[b]
        return whole

    def merge(self, piece: bytes) -> list[int]:
        """Apply the merge rules in their order, of equal ones the leftmost first."""
        ids = [self.inner_unit[b] for b in piece[:-1]] + [self.final_unit[piece[-1]]]
        rules = self.rules
        after, prior = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = [(*rules[p], k) for k, p in enumerate(zip(ids, ids[1:])) if p in rules]
        heapq.heapify(heap)
        while heap:
            _, made, k = heapq.heappop(heap)
            n = after[k]
            if ids[k] < 0 or n >= len(ids) or rules.get((ids[k], ids[n]), (0, -1))[1] != made:
                continue
            ids[k], ids[n], after[k] = made, -1, after[n]
            if after[k] < len(ids):
                prior[after[k]] = k
                if (p := (made, ids[after[k]])) in rules:
                    heapq.heappush(heap, (*rules[p], k))
            if prior[k] >= 0 and (p := (ids[prior[k]], made)) in rules:
                heapq.heappush(heap, (*rules[p], prior[k]))
        return [i for i in ids if i >= 0]

    def _rules_at(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of the rule for each pair of tokens, NEVER where there is none."""
        key = a.astype(np.int64) * self.size + b
        at = np.minimum(np.searchsorted(self._pairs, key), len(self._pairs) - 1)
        return np.where((self._pairs[at] == key) & (a >= 0) & (b >= 0), self._pair_rank[at], NEVER)

    def merge_all(self, pieces: list[bytes]) -> list[list[int]]:
        """``merge`` for many pieces: in every step each row of a table applies its earliest rule at its leftmost place."""
        found: list = [None] * len(pieces)
        order = sorted((k for k, p in enumerate(pieces) if len(p) <= TABLE_BYTES), key=lambda k: len(pieces[k]))
        for at in range(0, len(order), TABLE_ROWS):
            rows = np.array(order[at:at + TABLE_ROWS])
            sizes = np.array([len(pieces[k]) for k in rows])
            width = int(sizes[-1])
            inside = np.arange(width) < sizes[:, None]
            ids = np.full((len(rows), width + 1), -1, np.int32)
            ids[:, :-1][inside] = self._inner_units[np.frombuffer(b"".join([pieces[k] for k in rows]), np.uint8)]
            ids[np.arange(len(rows)), sizes - 1] = self._final_units[[pieces[k][-1] for k in rows]]
            rules = self._rules_at(ids[:, :-1], ids[:, 1:])
            while len(rows):
                k = rules.argmin(1)
                line = np.arange(len(rows))
                rule = rules[line, k]
                if (done := rule == NEVER).any():
                    for row, own in zip(rows[done].tolist(), ids[done].tolist()):
                        found[row] = own[:own.index(-1)]
                    rows, ids, rules, k, rule = rows[~done], ids[~done], rules[~done], k[~done], rule[~done]
                    line = np.arange(len(rows))
                ids[line, k] = self._made[rule]
                past = np.arange(ids.shape[1] - 1) > k[:, None]
                ids[:, :-1] = np.where(past, ids[:, 1:], ids[:, :-1])
                rules[:, :-1] = np.where(past[:, :-1], rules[:, 1:], rules[:, :-1])
                rules[line, k] = self._rules_at(ids[line, k], ids[line, k + 1])
                rules[line, k - 1] = np.where(k > 0, self._rules_at(ids[line, k - 1], ids[line, k]), rules[line, k - 1])
                ids[:, -1], rules[:, -1] = -1, np.where(k == rules.shape[1] - 1, rules[:, -1], NEVER)
        for k, own in enumerate(found):
            if own is None:
                found[k] = self.merge(pieces[k])
        return found

    def propose(self, piece: bytes) -> list[int]:
        """Greedy longest matches."""
        out, at, end, final = [], 0, len(piece), self.final
        while True:
            whole = final.get(piece[at:])
            if whole is not None:
                out.append(whole)
                return out
            node, to = self._steps, at
            for to in range(at, end - 1):
                step = node.get(piece[to])
                if step is None:
                    break
                node = step
                if -1 in node:
                    token, stop = node[-1], to + 1
            out.append(token)
            at = stop

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """Propose for all pieces, test all adjacent pairs at once, and merge the pieces with a failing pair."""
        found = [self.propose(p) for p in pieces]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((i for f in found for i in f), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(found)), sizes)
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, which = np.unique(flat[inside] * self.size + flat[inside + 1], return_inverse=True)
        good = self.compatible(pairs // self.size, pairs % self.size)
        failing = np.unique(owner[inside[~good[which]]]).tolist()
        for k, ids in zip(failing, self.merge_all([pieces[k] for k in failing])):
            found[k] = ids
        return found


def read_vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        return Vocabulary(file.read())


def lowered(text: str) -> str:
    """Composed form, then each letter to lower case whatever stands beside it."""
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def cuts(text: str) -> list[str]:
    """A text without special strings, in lower case, cut at white space."""
    text = lowered(text)
    return _BLANKS.split(text) if _NO_BLANKS.search(text) else text.split()


def pieces_of(cut: str) -> list[bytes]:
    return [cut.encode()] if cut.isascii() and cut.isalpha() else [p.encode() for p in PIECES.findall(cut)]


class Cuts(dict):
    """What each cut, and each special string, comes to; new cuts of a batch are worked out together by ``solve``."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.special = regex.compile("|".join(map(regex.escape, sorted(vocabulary.special, key=len, reverse=True))) or r"(?!)")

    def solve(self, cuts: list[str]) -> Iterable:
        raise NotImplementedError

    def split(self, text: str) -> list:
        """The keys of a text: cuts as text, special strings as a tuple of their id."""
        if "<" not in text or not self.special.search(text):
            return cuts(text)
        out, at = [], 0
        for m in self.special.finditer(text):
            out += [*cuts(text[at:m.start()]), (self.vocabulary.special[m[0]],)]
            at = m.end()
        return out + cuts(text[at:])

    def prepare(self, texts: Iterable[str]) -> list[list]:
        if len(self) > CACHE_ENTRIES:
            self.clear()
        rows = [self.split(t) for t in texts]
        new = [k for k in set().union(*rows) if k not in self]
        special = [k for k in new if isinstance(k, tuple)]
        plain = [k for k in new if not isinstance(k, tuple)]
        self.update(zip(plain, self.solve(plain)))
        self.update((k, self.special_value(k[0])) for k in special)
        return rows

    def special_value(self, token: int):
        raise NotImplementedError


class Encoded(Cuts):
    """The ids of a cut as little-endian 32-bit numbers."""

    def solve(self, cuts):
        pieces = [pieces_of(c) for c in cuts]
        distinct = list(set().union(*pieces))
        known = {p: np.array(i, "<u4").tobytes() for p, i in zip(distinct, self.vocabulary.encode_pieces(distinct))}
        return (b"".join([known[p] for p in own]) for own in pieces)

    def special_value(self, token):
        return np.array([token], "<u4").tobytes()


class Counted(Cuts):
    """The number of tokens of a cut: whole tokens by look-up, the rest by merging."""

    def __init__(self, vocabulary):
        super().__init__(vocabulary)
        self.single = {p for p, i in vocabulary.final.items() if vocabulary.whole[i]}

    def solve(self, cuts):
        pieces = [pieces_of(c) for c in cuts]
        rest = {p for own in pieces for p in own if p not in self.single}
        rest = list(rest)
        known = {p: len(i) for p, i in zip(rest, self.vocabulary.merge_all(rest))}
        return (sum([known.get(p, 1) for p in own]) for own in pieces)

    def special_value(self, token):
        return 1


_workers: dict[tuple, Cuts] = {}


def _cuts_of(kind: type[Cuts], vocabulary) -> Cuts:
    """One look-up table for each Python worker and vocabulary."""
    key = kind, vocabulary.id
    if key not in _workers:
        _workers.clear()
        _workers[key] = kind(vocabulary.value)
    return _workers[key]


class _Shared:
    def __init__(self, broadcast, key) -> None:
        self.broadcast, self.id = broadcast, key

    @property
    def value(self) -> Vocabulary:
        return self.broadcast.value


def _parts(batch: pa.RecordBatch, bytes_each: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows of about so many bytes of text."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + bytes_each, "right")))
        yield batch.slice(at, to - at)
        at = to


def encode_texts(df: DataFrame, vocabulary: str | Vocabulary, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_tokens long, ids binary)`` for every row; ids are little-endian unsigned 32-bit numbers.

    Only the key and the text are read, so other columns cannot clash. Empty and null texts have no ids; repeated rows and keys are
    kept as they are; an empty table gives no rows.
    """
    shared = _share(df, vocabulary)

    def run(batches):
        table = _cuts_of(Encoded, shared)
        for batch in batches:
            for part in _parts(batch):
                ids = [b"".join([table[c] for c in row]) for row in table.prepare(t or "" for t in part.column(1).to_pylist())]
                yield pa.record_batch([part.column(0), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary())],
                                      names=["key", "n_tokens", "ids"])
            give_back()

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        run, f"key {kind}, n_tokens long, ids binary").withColumnRenamed("key", key)


def _share(df: DataFrame, vocabulary: str | Vocabulary) -> _Shared:
    value = read_vocabulary(vocabulary) if isinstance(vocabulary, str) else vocabulary
    broadcast = df.sparkSession.sparkContext.broadcast(value)
    return _Shared(broadcast, value.name)


def decode_ids(df: DataFrame, vocabulary: str | Vocabulary, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the text of the packed ``ids``: the tokens joined by blanks, special ones included; null for null ids."""
    value = read_vocabulary(vocabulary) if isinstance(vocabulary, str) else vocabulary
    # the strings alone: workers that decode need none of the tables of the merges
    shared = df.sparkSession.sparkContext.broadcast(value.tokens)

    def run(batches):
        tokens = shared.value
        for batch in batches:
            at = batch.schema.get_field_index(ids)
            for k in range(0, batch.num_rows, 500):
                part = batch.slice(k, 500)
                texts = [None if b is None else " ".join([tokens[i] for i in np.frombuffer(b, "<u4").tolist()]) for b in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, out])
            give_back()

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, f"{fields}, `{out}` string")


def count_tokens(df: DataFrame, vocabulary: str | Vocabulary, limit: int = 2048, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_bytes long, n_tokens long, over_limit boolean)`` for every row; ``limit`` only sets the mark.

    Only the key and the text are read. Empty and null texts have no tokens; repeated rows are kept; an empty table gives no rows.
    """
    shared = _share(df, vocabulary)

    def run(batches):
        table = _cuts_of(Counted, shared)
        for batch in batches:
            for part in _parts(batch):
                counts = [sum([table[c] for c in row]) for row in table.prepare(t or "" for t in part.column(1).to_pylist())]
                sizes = pc.fill_null(pc.binary_length(part.column(1)), 0).cast(pa.int64())
                yield pa.record_batch([part.column(0), sizes, pa.array(counts, pa.int64())], names=["key", "n_bytes", "n_tokens"])

    kind = df.schema[key].dataType.simpleString()
    counted = df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
