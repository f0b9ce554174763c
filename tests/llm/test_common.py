"""The shared helpers: bounded samples, ranges by size, free names, word hashes."""

import numpy as np
from pyspark.sql import functions as F

from ledgerlens.llm import common
from ledgerlens.llm.words import hashed_words


def test_lowest_is_the_sorted_head(llm):
    df = llm.range(40_000).select(F.xxhash64("id").alias("h"), "id")
    want = [tuple(r) for r in df.orderBy("h", "id").limit(300).collect()]
    assert sorted(map(tuple, common.lowest(df, "h", 300).collect())) == sorted(want)
    few = llm.range(10).select(F.xxhash64("id").alias("h"), "id")
    assert common.lowest(few, "h", 300).count() == 10 and common.lowest(few.limit(0), "h", 5).count() == 0


def test_spans():
    assert list(common.spans([3, 3, 3, 100, 1], 7)) == [(0, 2), (2, 3), (3, 4), (4, 5)]
    assert list(common.spans([], 7)) == [] and list(common.spans([0, 0], 7)) == [(0, 2)]


def test_free_name(llm):
    df = llm.createDataFrame([(1, 2)], "Kept int, kept_ int")
    assert common.free_name(df, "kept") == "kept__"


def test_word_hashes_depend_on_the_word_alone():
    text = b"  one two one  twoone one"
    data = np.frombuffer(text, np.uint8)
    hashes, starts = hashed_words(data, data == 32)
    words = [text[s:].split()[0] for s in starts]
    assert words == [b"one", b"two", b"one", b"twoone", b"one"]
    assert len(set(hashes.tolist())) == 3 and hashes[0] == hashes[2] == hashes[4]
    assert len(hashed_words(data[:0], data[:0] == 32)[0]) == 0
