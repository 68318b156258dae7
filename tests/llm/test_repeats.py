import hashlib
import random
import re

import numpy as np
import pytest

from larder.llm import anchors
from larder.llm.fm_dedup import remove_earlier
from larder.llm.fm_index import FMIndex
from larder.llm.suffix_dedup import remove_repeats
from larder.llm.tables import keyed, plain


def brute_bytes(rows, least):
    seen = {}
    for k, (_, text) in enumerate(rows):
        raw = (text or "").encode()
        for i in range(len(raw) - least + 1):
            seen[raw[i : i + least]] = seen.get(raw[i : i + least], 0) + 1
    out = []
    for doc_id, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - least + 1):
            if seen[raw[i : i + least]] > 1:
                gone[i : i + least] = b"\1" * least
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((doc_id, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def brute_words(rows, window):
    split = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    first = {}
    for d, w in split:
        d = float("inf") if d is None else d
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            first[key] = min(first.get(key, d), d)
    out = []
    for d, w in split:
        own = float("inf") if d is None else d
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < own:
                gone[i : i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def corpus(seed):
    pick = random.Random(seed)
    word = lambda: "".join(pick.choice(["to", "ña", "e", "ri", "ß"]) for _ in range(pick.randint(1, 3)))
    passages = [[word() for _ in range(pick.randint(10, 60))] for _ in range(8)]
    rows = []
    for k in range(90):
        words = []
        for _ in range(pick.randint(0, 5)):
            part = list(pick.choice(passages)) if pick.random() < 0.6 else [word() for _ in range(pick.randint(1, 40))]
            if pick.random() < 0.3:
                part[pick.randrange(len(part))] = word()
            words += part
        rows.append((k * 7 % 101, pick.choice([" ", "  ", " \n"]).join(words)))
    rows += [(200, None), (201, ""), (202, " \n "), (203, "he " * 900), (204, "x" * 1000), (205, rows[5][1]), (5, rows[5][1])]
    rows += [(None, rows[6][1]), (None, "no id " * 10), (206, rows[6][1]), (206, rows[6][1])]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "s", 1) for d, t in rows], "doc_id long, text string, spans string, h int").repartition(5)


def key(rows):
    return sorted(rows, key=lambda r: tuple((v is None, v) for v in r))


@pytest.mark.parametrize("least,hot", [(50, 20_000), (50, 2), (200, 20_000)])
def test_bytes_as_brute_force(spark, least, hot):
    rows = corpus(least + hot)
    found = remove_repeats(frame(spark, rows), least, cell_bits=20, hot=hot).collect()
    assert key(map(tuple, found)) == key(brute_bytes(rows, least))


@pytest.mark.parametrize("window,hot", [(13, 20_000), (13, 2), (6, 20_000)])
def test_words_as_brute_force(spark, window, hot):
    rows = corpus(window + hot)
    found = remove_earlier(frame(spark, rows), window, cell_bits=20, hot=hot).collect()
    assert key(map(tuple, found)) == key(brute_words(rows, window))


def test_chance_passes_of_the_bitmap_are_not_shipped(spark):
    """Anchors of no repeat at all share cells with each other; none is taken for an anchor of several classes."""
    pick = random.Random(9)
    word = lambda: "".join(pick.choice("abcdefghijklmnop") for _ in range(8))
    docs = [(k, " ".join(word() for _ in range(120)), None) for k in range(40)]
    copied = " ".join(word() for _ in range(30))

    def segments_of(batch):
        words = anchors.words_of_bytes(*anchors.buffer_of(batch.column(2)))
        return anchors.segments(anchors.word_values(words), words.offsets, 13, 5), lambda s, k: b"x"

    for rows, more in ((docs, 0), (docs + [(k, f"{word()} {copied} {word()}", None) for k in (50, 51)], 1)):
        texts = keyed(plain(spark.createDataFrame(rows, "doc_id long, text string, s string"))).select("k1", "k2", "text").repartition(3)
        found = anchors.repeats(texts, segments_of, 9, 20_000)
        several, alone = found.shards.where("n > 0").count(), found.alone.count()
        assert found.often is None
        assert (several + alone > 0) == (more > 0) and several <= 8 * more
        assert found.alone.where("n < 2").count() == 0


def test_small_arrays_are_held_together(monkeypatch):
    monkeypatch.setattr(anchors, "HELD", 5)
    parts = [(np.arange(n), np.arange(n) + 1) for n in (0, 2, 4, 0, 7, 1)]
    held = list(anchors._held(iter(parts)))
    assert [len(a) for a, _ in held] == [6, 7, 1]
    assert np.concatenate([a for a, _ in held]).tolist() == np.concatenate([a for a, _ in parts]).tolist()
    assert anchors.enough_bits(10, 20) == 20 and anchors.enough_bits(1 << 20, 20) == 25 and anchors.enough_bits(1 << 40, 27) == anchors.MOST_BITS


def test_empty_tables(spark):
    assert remove_repeats(frame(spark, []).limit(0), cell_bits=20).count() == 0
    assert remove_earlier(frame(spark, []).limit(0), cell_bits=20).count() == 0


def test_matching_statistics():
    pick = np.random.default_rng(3)
    symbols = pick.integers(0, 5, 300)
    index = FMIndex(symbols, 8)
    text = pick.integers(1, 6, 100)
    length, low, high = index.matching_statistics(text, np.arange(100))
    strings = {n: [tuple(symbols[i : i + n]) for i in range(len(symbols) - n + 1)] for n in range(1, 9)}
    for end in range(100):
        best = max([0, *(n for n in range(1, min(8, end + 1) + 1) if tuple(text[end - n + 1 : end + 1]) in strings[n])])
        assert length[end] == best
        if best:
            assert high[end] - low[end] == strings[best].count(tuple(text[end - best + 1 : end + 1]))
