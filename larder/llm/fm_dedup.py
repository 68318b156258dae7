"""Repeated word windows by FM-index.

Each shard of segments with common anchors has an index of its own. The shard's segments stream through backward search;
the matching statistics at each word give the windows that occur, and the interval of each gives the least document that
has it. Windows that start in an earlier document are removed.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.anchors import (
    CELL_BITS, COVERS, HOT, Shard, buffer_of, by_windows, merged, repeats, segments, shard_of, signed, with_spans,
    word_values, words_of_bytes,
)
from larder.llm.fm_index import FMIndex
from larder.llm.tables import batch_from, batch_of, keyed, plain

WINDOW = 13
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def symbols_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Words as numbers from 1 on, texts separated by 0, and the number of words of each."""
    index: dict[bytes, int] = {}
    flat, sizes = [], []
    for t in texts:
        words = t.split(b" ")
        flat += [index.setdefault(w, len(index) + 1) for w in words]
        flat.append(0)
        sizes.append(len(words))
    return np.array(flat, np.int64), np.array(sizes, np.int64)


def least_of(index: FMIndex, of_position: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The least value among the suffixes of each interval; intervals are equal or disjoint."""
    values = np.append(of_position[index.suffixes], np.iinfo(np.int64).max)
    starts, inverse = np.unique(low, return_inverse=True)
    stops = np.zeros(len(starts), np.int64)
    stops[inverse] = high
    return np.minimum.reduceat(values, np.stack([starts, stops], 1).ravel())[::2][inverse]


def covers_of(shard: Shard, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each class the run of words in windows that also start before its own first document."""
    symbols, sizes = symbols_of(shard.data)
    begin = np.cumsum(sizes + 1) - (sizes + 1)
    owner = np.repeat(np.arange(len(sizes)), sizes + 1)
    index = FMIndex(symbols, window)
    first = shard.first[owner]
    windows = sizes - window + 1
    which = np.repeat(np.arange(len(sizes)), windows)
    offset = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    low = np.full(len(sizes), np.iinfo(np.int64).max)
    high = np.zeros(len(sizes), np.int64)
    step = 1 << 18
    for a in range(0, len(which), step):  # documents stream through in pieces
        seg, o = which[a : a + step], offset[a : a + step]
        length, lo, hi = index.matching_statistics(symbols, begin[seg] + o + window - 1, 2)
        hit = np.flatnonzero(length >= window)
        if not len(hit):
            continue
        earlier = least_of(index, first, lo[hit], hi[hit]) < shard.first[seg[hit]]
        seg, o = seg[hit][earlier], o[hit][earlier]
        np.minimum.at(low, seg, o)
        np.maximum.at(high, seg, o + window)
    low[high == 0] = 0
    return low, high


KEPT = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"


def earlier_spans(docs: DataFrame, window: int = WINDOW, cell_bits: int = CELL_BITS, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """Rows of doc_id, text, k1, k2, and spans (k1, k2, a, b) of words in windows that start in an earlier document."""
    gram = max(1, window * 2 // 5)
    rows = keyed(plain(docs)).select("k1", "k2", "text", "doc_id")
    texts = rows.select("k1", "k2", "text")

    def segments_of(batch):
        buffer, offsets = buffer_of(batch.column(2))
        words = words_of_bytes(buffer, offsets)

        def content(s, k):
            a, b = s.low[k], s.high[k]
            return b" ".join(WORD.findall(buffer[words.start[a] : words.stop[b - 1]].tobytes()))

        return segments(word_values(words), words.offsets, window, gram), content

    found = repeats(texts, segments_of, cell_bits, hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = shard_of(batches)
        if shard is not None and len(shard.n):
            low, high = covers_of(shard, window)
            yield batch_from([signed(shard.key), signed(shard.content), shard.first, low, high], COVERS)

    # An anchor with one class has no other windows: later documents are covered, the first one isn't.
    zero = F.lit(0)
    alone = found.alone.select("h", "c", "first", zero.alias("low"), zero.alias("high"))
    covers = found.shards.mapInArrow(run, COVERS).unionByName(alone)

    def window_of(o):
        words = F.slice(F.split(F.col("data").cast("string"), " "), o + 1, F.lit(window))
        return F.array_join(words, " ").cast("binary")

    often = by_windows(found, texts, segments_of, cell_bits, window_of, window, F.col("all.first") < F.col("own.first"))
    if often is not None:
        covers = covers.unionByName(often)
    met = found.places.join(covers, ["h", "c"])
    later = F.col("k1") > F.col("first")
    spans = met.where(later | (F.col("high") > F.col("low"))).select(
        "k1",
        "k2",
        F.when(later, F.col("start")).otherwise(F.col("start") + F.col("low")).alias("a"),
        F.when(later, F.col("start") + F.col("windows") + (window - 1)).otherwise(F.col("start") + F.col("high")).alias("b"),
    )
    return rows, spans


def remove_earlier(docs: DataFrame, window: int = WINDOW, cell_bits: int = CELL_BITS, hot: int = HOT) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of each row's words, which are runs without ASCII white space.

    Each word goes that a window of ``window`` words covers whose words also start in a document with a smaller doc_id,
    judged on the input. A null id counts as larger than all others. Rows that repeat an id don't cover each other. Null
    text has no words. ``cell_bits`` bounds a filter and ``hot`` the classes of one anchor in a task; neither changes the
    result.
    """
    rows, spans = earlier_spans(docs, window, cell_bits, hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, found in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                words = WORD.findall(text.as_buffer().to_pybytes())
                runs = merged(found, len(words))
                ends = [0, *(b for _, b in runs)]
                kept = [w for a, b in zip(ends, [*(a for a, _ in runs), len(words)]) for w in words[a:b]]
                out.append((doc_id, len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            if out:
                yield batch_of(out, KEPT)

    return with_spans(rows, spans).mapInArrow(run, KEPT)
