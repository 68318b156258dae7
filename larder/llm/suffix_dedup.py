"""Repeated byte strings by enhanced suffix arrays.

A shard has all segments that share an anchor. The suffixes that begin at the anchors are sorted, with the common prefix
of neighbours beside them; a scan with a stack walks the tree of common-prefix intervals. Within an interval the members
are compared by what stands left of the anchor: members whose left and right matches together are long enough form a
maximal repeat group, all of them, not just neighbours in the array.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.anchors import (
    CELL_BITS, COVERS, HOT, Shard, buffer_of, by_windows, byte_values, merged, repeats, segments, shard_of, signed,
    with_spans,
)
from larder.llm.tables import batch_from, batch_of, keyed, plain

LENGTH = 200


def common_prefixes(texts: list[bytes]) -> np.ndarray:
    """Length of the common prefix of each text with the one before it; 0 for the first."""
    n = len(texts)
    sizes = np.array([len(t) for t in texts], np.int64)
    out = np.zeros(n, np.int64)
    widest = int(sizes.max()) if n else 0
    step = max(1, (8 << 20) // max(widest, 1))
    for a in range(0, n, step):
        b = min(n, a + step)
        low = max(a - 1, 0)
        rows = np.zeros((b - low, widest), np.uint8)
        mask = np.arange(widest) < sizes[low:b, None]
        rows[mask] = np.frombuffer(b"".join(texts[low:b]), np.uint8)
        differ = rows[1:] != rows[:-1]
        same = np.where(differ.any(1), differ.argmax(1), widest) if widest else np.zeros(b - low - 1, np.int64)
        out[low + 1 : b] = np.minimum(same, np.minimum(sizes[low + 1 : b], sizes[low : b - 1]))
    return out


def intervals(lcp: list[int], floor: int) -> Iterator[tuple[int, int, int]]:
    """Common-prefix intervals (depth, first, last) of at least ``floor``, inner ones before those that hold them."""
    stack: list[tuple[int, int]] = []  # depth, first
    for k in range(1, len(lcp) + 1):
        depth = lcp[k] if k < len(lcp) else 0
        first = k - 1
        while stack and stack[-1][0] > depth:
            d, first = stack.pop()
            yield d, first, k - 1
        if depth >= floor and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))


def shared(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid - 1)
    return low


def repeat_groups(lefts: list[bytes], rights: list[bytes], least: int) -> Iterator[list[tuple[int, int, int]]]:
    """Maximal repeat groups of strings that run through the anchors: members as (text, left match, right match).

    ``lefts``: what stands before each anchor, reversed. A member is listed with its longest left match to any other
    member of the interval. An interval whose members all go on alike to the left is left-extended by that match, so what
    is reported can't be extended by all members.
    """
    order = sorted(range(len(rights)), key=rights.__getitem__)
    lcp = common_prefixes([rights[k] for k in order]).tolist()
    deepest = max(map(len, lefts), default=0)
    for depth, first, last in intervals(lcp, max(1, least - deepest)):
        if last == first + 1:
            a, b = order[first], order[last]
            match = shared(lefts[a], lefts[b])
            if match + depth >= least:
                yield [(a, match, depth), (b, match, depth)]
            continue
        members = sorted(order[first : last + 1], key=lefts.__getitem__)
        near = [shared(lefts[a], lefts[b]) for a, b in zip(members, members[1:])]
        best = map(max, [0, *near], [*near, 0])
        group = [(k, match, depth) for k, match in zip(members, best) if match + depth >= least]
        if group:
            yield group


def covers_of(shard: Shard, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each class the run of bytes that occur elsewhere too: all of it if it has several occurrences itself."""
    n = len(shard.n)
    low, high = np.zeros(n, np.int64), np.zeros(n, np.int64)
    sizes = np.array([len(d) for d in shard.data], np.int64)
    several = shard.n > 1
    high[several] = sizes[several]
    anchor = shard.anchor.tolist()
    cuts = np.flatnonzero(np.append(True, shard.key[1:] != shard.key[:-1])).tolist() + [n]
    for a, b in zip(cuts, cuts[1:]):
        if b - a < 2 or several[a:b].all():
            continue
        members = range(a, b)
        lefts = [shard.data[k][: anchor[k]][::-1] for k in members]
        rights = [shard.data[k][anchor[k] :] for k in members]
        for group in repeat_groups(lefts, rights, least):
            for k, left, right in group:
                at, k = anchor[a + k], a + k
                if high[k] == 0:
                    low[k], high[k] = at - left, at + right
                else:
                    low[k], high[k] = min(low[k], at - left), max(high[k], at + right)
    return low, high


KEPT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def repeated_spans(docs: DataFrame, least: int = LENGTH, cell_bits: int = CELL_BITS, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """Rows of doc_id, text, k1, k2, and spans (k1, k2, a, b) of bytes that lie in a repeated string.

    Of a span every byte is covered by a string of ``least`` bytes that also starts elsewhere. Spans may overlap.
    """
    gram = max(1, least * 4 // 25)
    rows = keyed(plain(docs)).select("k1", "k2", "text", "doc_id")
    texts = rows.select("k1", "k2", "text")

    def segments_of(batch):
        buffer, offsets = buffer_of(batch.column(2))
        return segments(byte_values(buffer), offsets, least, gram), lambda s, k: buffer[s.low[k] : s.high[k]].tobytes()

    found = repeats(texts, segments_of, cell_bits, hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = shard_of(batches)
        if shard is not None:
            low, high = covers_of(shard, least)
            k = np.flatnonzero(high > low)
            yield batch_from([signed(shard.key[k]), signed(shard.content[k]), shard.first[k], low[k], high[k]], COVERS)

    # An anchor with one class is a tree of one leaf; all its occurrences are a group.
    whole = F.lit(1 << 30)
    alone = found.alone.select("h", "c", "first", F.lit(0).alias("low"), whole.alias("high"))
    covers = found.shards.mapInArrow(run, COVERS).unionByName(alone)
    window_of = lambda o: F.substring("data", o + 1, F.lit(least))
    often = by_windows(found, texts, segments_of, cell_bits, window_of, least, F.col("all.n") > 1)
    if often is not None:
        covers = covers.unionByName(often.where("high > low"))
    met = found.places.join(covers, ["h", "c"])
    spans = met.select("k1", "k2", (F.col("start") + F.col("low")).alias("a"), (F.col("start") + F.least("high", F.col("windows") + (least - 1))).alias("b"))
    return rows, spans


def remove_repeats(docs: DataFrame, least: int = LENGTH, cell_bits: int = CELL_BITS, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each row's text as UTF-8.

    Each byte goes that is covered by a string of ``least`` bytes which starts anywhere else too, in the same text or
    another; matches don't cross texts and are judged on the input. Null text is empty. Rows that repeat are copies of
    each other. ``cell_bits`` bounds a filter and ``hot`` the classes of one anchor in a task; neither changes the result.
    """
    rows, spans = repeated_spans(docs, least, cell_bits, hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, found in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                raw = text.as_buffer().to_pybytes()
                runs = merged(found, len(raw))
                ends = [0, *(b for _, b in runs)]
                kept = b"".join(raw[a:b] for a, b in zip(ends, [*(a for a, _ in runs), len(raw)]))
                out.append((doc_id, len(raw), len(raw) - len(kept), len(runs), hashlib.sha256(kept).hexdigest()))
            if out:
                yield batch_of(out, KEPT)

    return with_spans(rows, spans).mapInArrow(run, KEPT)
