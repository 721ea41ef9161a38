"""Packing against plain encoding, and the bins against a list of free places."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from trendloom.llm.packing import OpenBins, pack_documents, packing_digest
from trendloom.llm.tokens import WordEncoder, default_tokenizer

TEXTS = [
    (1, "Hello  world, it's 42!\n\tNew line"), (2, ""), (3, None), (4, " \n "), (None, "no id"), (6, "a b c " * 3000),
    (6, "a b c " * 3000), (7, "été   é <|endoftext|> x y 'S don't"), (8, "́ word\x1cother"),
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(default_tokenizer())


def expected(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")


def check(rows, texts, tokenizer, capacity):
    wanted = defaultdict(list)
    for doc_id, text in texts:
        ids = expected(tokenizer, text)
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            wanted[doc_id, piece].append((start, len(part), zlib.crc32(part.tobytes())))
    found, places = defaultdict(list), defaultdict(list)
    for r in rows:
        found[r.doc_id, r.piece].append((r.start, r.length, r.ids_crc32))
        places[r.sequence_id].append((r.offset, r.length))
    assert found == wanted
    for members in places.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= capacity
    return sum(len(expected(tokenizer, t)) for _, t in texts), len(places)


def test_pieces_and_places(spark, tokenizer):
    docs = spark.createDataFrame([(d, t, "x", 5) for d, t in TEXTS], "doc_id long, text string, piece string, start int")
    for capacity, open_bins in ((4096, 512), (50, 3)):
        rows = packing_digest(pack_documents(docs, capacity=capacity, open_bins=open_bins)).collect()
        check(rows, TEXTS, tokenizer, capacity)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing_digest(pack_documents(docs)).count() == 0


def test_whole_table(spark, sf_dir, tokenizer):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    tokens, made = check(packing_digest(pack_documents(docs)).collect(), texts, tokenizer, 4096)
    parts = docs.rdd.getNumPartitions()
    assert made <= 1.05 * tokens / 4096 + 1 + parts


def test_small_memory_gives_the_same_ids(tokenizer):
    encoder = WordEncoder(default_tokenizer(), bytes_kept=3)
    for text in ("one two three four five six", "six five four", "one one seven"):
        assert encoder.encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_open_bins_like_a_plain_list():
    rng = random.Random(3)
    for limit in (1, 4, 50):
        bins, plain, made = OpenBins(100, limit), [], 0
        for _ in range(2000):
            length = rng.randint(1, 100)
            number, offset = bins.place(length)
            fitting = [free for free, _ in plain if free >= length]
            if fitting:
                assert 100 - offset == min(fitting)
                assert (min(fitting), number) in plain
                plain.remove((min(fitting), number))
            else:
                assert (number, offset) == (made, 0)
                made += 1
            if left := 100 - offset - length:
                plain.append((left, number))
            if len(plain) > limit:
                least = min(free for free, _ in plain)
                gone = [p for p in plain if p[0] == least and p[1] not in sum(bins.bins.values(), [])]
                assert len(gone) == 1
                plain.remove(gone[0])


def test_every_kind_of_word_is_encoded_as_by_the_tokenizer(tokenizer):
    words = "Straße ẞ É él él. ÉL, İ K Å naïve. a.b a., don't I'll 'S x² ½ ÿ Ÿ ﬁ ñandú, São-Paulo ... , . ×÷ ªº µ é É. ­ x y 漢字 абв ß. SS word... end,. U.S. U.S., e.g. 3. 3, x'. ,a .b. <|startoftext|> <|STARTOFTEXT|>. a.\xa0b Á. Å,".split(" ")
    encoder = WordEncoder(default_tokenizer(), bytes_kept=530_000)
    for k in range(0, len(words), 5):
        texts = [" ".join(words[k : k + 5]), *words[k : k + 5], None]
        for text, ids in zip(texts, encoder.encode_all(texts)):
            assert ids.tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids, text
