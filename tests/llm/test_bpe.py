import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm.brute import odd_documents
from prefloom.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.read_vocabulary(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def odd_texts():
    rnd = random.Random(5)
    letters = "aAbcdeEstmlvr'''.,!?-_ \t\n\x1c\x85 ​éÉßΣσςİı가각12२½²Ⅷ\U0001F600́"
    special = ["", "<|endoftext|>", "<|startoftext|>", "<|endoftext|"]
    return ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60))) + rnd.choice(special) + "".join(rnd.choice("abcdefghi stuvw") for _ in range(40))
            for _ in range(400)] + ["", "a" * 500, "ab" * 300, "the" * 200, *("a" * k for k in range(20))]


def test_encoding_is_the_librarys(vocabulary, library):
    texts = odd_texts()
    table = bpe.Encoded(vocabulary)
    got = [np.frombuffer(b"".join(table[c] for c in row), "<u4").tolist() for row in table.prepare(texts)]
    assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_counts_are_the_librarys(vocabulary, library):
    texts = odd_texts()
    table = bpe.Counted(vocabulary)
    assert [sum(table[c] for c in row) for row in table.prepare(texts)] == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_whole_tokens_are_what_merging_gives(vocabulary):
    for token, i in random.Random(1).sample(sorted(vocabulary.final.items()), 500):
        assert (vocabulary.merge(token) == [i]) == vocabulary.whole[i]


def test_tables_and_heap_merge_alike(vocabulary):
    rnd = random.Random(2)
    pieces = ["".join(rnd.choice("aeinrst") for _ in range(rnd.randint(1, 60))).encode() for _ in range(500)]
    merged = [vocabulary.merge(p) for p in pieces]
    assert vocabulary.merge_all(pieces) == merged == vocabulary.encode_pieces(pieces)


def test_operators(spark, vocabulary, library):
    docs = odd_documents(spark)
    want = {(r.doc_id, r.text): library.encode(r.text or "", add_special_tokens=False).ids for r in docs.collect()}
    encoded = bpe.decode_ids(bpe.encode_texts(docs, vocabulary), PATH)
    got = sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist(), r.decoded) for r in encoded.collect()), key=repr)
    rows = [(r.doc_id, want[r.doc_id, r.text]) for r in docs.collect()]
    assert got == sorted(((k, i, library.decode(i, skip_special_tokens=False)) for k, i in rows), key=repr)
    counted = bpe.count_tokens(docs, vocabulary, limit=20)
    want = [(r.doc_id, len((r.text or "").encode()), len(want[r.doc_id, r.text]), len(want[r.doc_id, r.text]) > 20) for r in docs.collect()]
    assert sorted(map(tuple, counted.collect()), key=repr) == sorted(want, key=repr)
    assert bpe.encode_texts(docs.limit(0), vocabulary).collect() == bpe.count_tokens(docs.limit(0), vocabulary).collect() == []
