"""Byte-pair encoding by a pair occurrence index, and decoding.

The distinct words of a piece of a partition are laid out as one array of symbols. An index maps each pair of
neighbouring symbols to all its positions. Active ranks are applied in ascending order, each to all its positions at
once; a merge changes only the lists of the pairs beside it.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, compress, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from larder.llm.tables import batch_from, plain, slices

CHUNK_BYTES = 16 << 20
KEPT_WORDS = 200_000
ENCODED = "doc_id bigint, ids array<int>"
# White space of str.split() that is no white space to the vocabulary's pattern, or not ASCII.
ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
ASCII_SPACE = re.compile("[ \t\n\x0b\x0c\r]+")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable in Latin-1, else the next free one from 256 on."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    letters, free = {b: chr(b) for b in printable}, 256
    for b in range(256):
        if b not in letters:
            letters[b] = chr(free)
            free += 1
    return [letters[b] for b in range(256)]


class Vocabulary:
    """A word-end BPE vocabulary file: normalised to NFC and lower case, split by its pattern, bytes as letters."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))) + ")")
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(split["pattern"]["Regex"])
        self.tokens = np.empty(max([*vocab.values(), *self.specials.values()]) + 1, object)
        for text, i in [*vocab.items(), *self.specials.items()]:
            self.tokens[i] = text
        self.base = 1 << 20
        keys = np.array([vocab[a] * self.base + vocab[b] for a, b in model["merges"]], np.int64)
        self.left, self.right = keys // self.base, keys % self.base
        self.made = np.array([vocab[a + b] for a, b in model["merges"]], np.int64)
        self.by_key = np.argsort(keys)
        self.keys = keys[self.by_key]
        letters = byte_letters()
        self.letter_bytes = {c: b for b, c in enumerate(letters)}
        self.path, self.library = path, None
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.final = np.array([vocab[c + end] for c in letters], np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 where it never merges."""
        key = a * self.base + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.by_key[at], -1)

    def pieces(self, word: str) -> list[str | int]:
        """What the merges work on; a special token is its id."""
        if word.isascii() and word.isalpha():
            return [word.lower()]
        found = []
        for k, part in enumerate(self.special.split(word) if "<|" in word else (word,)):
            if k % 2:
                found.append(self.specials[part])
            elif part:
                if part.isprintable():
                    # Letter by letter: the lower case of sigma doesn't depend on its place.
                    found += self.pattern.findall(unicodedata.normalize("NFC", part).replace("Σ", "σ").lower())
                else:
                    found += self.rare_pieces(part)
        return found

    def rare_pieces(self, part: str) -> list[str]:
        """Unassigned and control characters: Unicode versions differ in them, so the vocabulary's own library splits."""
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        split = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(part))
        return [bytes(map(self.letter_bytes.__getitem__, letters)).decode("utf-8", "surrogatepass") for letters, _ in split]

    def merge(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces in one array, and how many each has."""
        raw = [p.encode() for p in pieces]
        sizes = np.array([len(r) for r in raw], np.int64)
        sym = self.inner[np.frombuffer(b"".join(raw), np.uint8)]
        n = len(sym)
        ends = np.cumsum(sizes)
        last = ends - 1
        sym[last] = self.final[np.frombuffer(b"".join(raw), np.uint8)[last]]
        after = np.arange(1, n + 1)
        after[last] = -1
        before = np.arange(-1, n - 1)
        before[ends - sizes] = -1
        alive = np.ones(n, bool)

        lists: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def note(positions: np.ndarray) -> None:
            ranks = self.rank(sym[positions], sym[after[positions]])
            positions, ranks = positions[ranks >= 0], ranks[ranks >= 0]
            if not len(ranks):
                return
            order = np.argsort(ranks, kind="stable")
            positions, ranks = positions[order], ranks[order]
            cuts = np.flatnonzero(np.diff(ranks)) + 1
            starts = [0, *cuts.tolist()]
            for k, start, stop in zip(ranks[starts].tolist(), starts, [*starts[1:], len(ranks)]):
                if k in lists:
                    lists[k].append(positions[start:stop])
                else:
                    lists[k] = [positions[start:stop]]
                    heapq.heappush(active, k)

        note(np.flatnonzero(after >= 0))
        while active:
            k = heapq.heappop(active)
            found = lists.pop(k)
            p = found[0] if len(found) == 1 else np.unique(np.concatenate(found))
            a, b = self.left[k], self.right[k]
            q = after[p]
            ok = alive[p] & (q >= 0) & (sym[p] == a)
            ok[ok] = sym[q[ok]] == b
            p, q = p[ok], q[ok]
            if a == b and len(p) > 1:  # of overlapping pairs the left one merges
                p = np.sort(p)
                keep, taken = [], -1
                for i, j in zip(p.tolist(), after[p].tolist()):
                    keep.append(i != taken)
                    taken = j if i != taken else -1
                p = p[np.array(keep)]
                q = after[p]
            if not len(p):
                continue
            sym[p] = self.made[k]
            alive[q] = False
            nxt = after[q]
            after[p] = nxt
            has = nxt >= 0
            before[nxt[has]] = p[has]
            prev = before[p]
            near = np.concatenate([prev[prev >= 0], p[has]])
            if len(near):
                note(np.unique(near) if len(near) > 1 else near)
        counts = np.add.reduceat(alive, ends - sizes) if n else np.zeros(0, np.int64)
        return sym[alive].astype(np.int32), counts.astype(np.int64)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in one array, and how many each has."""
        index = Numbered()
        found = [self.pieces(word) for word in words]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = list(map(index.__getitem__, chain.from_iterable(found)))
        names = list(index)
        special = np.array([isinstance(p, int) for p in names], bool)
        ids, counts = self.merge([p for p in names if not isinstance(p, int)])
        if special.any():
            all_counts = np.ones(len(names), np.int64)
            all_counts[~special] = counts
            all_ids = np.empty(all_counts.sum(), np.int32)
            of = np.repeat(special, all_counts)
            all_ids[~of] = ids
            all_ids[of] = [p for p in names if isinstance(p, int)]
            ids, counts = all_ids, all_counts
        flat = np.array(flat, np.int64)
        ids, piece_counts = gather(ids, counts, flat)
        bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        total = np.concatenate([[0], np.cumsum(piece_counts)])
        return ids, np.diff(total[bounds])

    def decode(self, ids) -> str:
        return " ".join(self.tokens[ids].tolist())


def gather(values: np.ndarray, counts: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``values`` named by ``which``, one after the other, and their lengths."""
    starts = np.cumsum(counts) - counts
    n = counts[which]
    shift = starts[which] - (np.cumsum(n) - n)
    return values[np.repeat(shift, n) + np.arange(n.sum())], n


def words_of(text: str) -> list[str]:
    return [w for w in ASCII_SPACE.split(text) if w] if ODD_SPACE.search(text) else text.split()


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Numbered(dict):
    """Numbers words in the order in which they are first asked for."""

    def __missing__(self, word: str) -> int:
        k = self[word] = len(self)
        return k


class WordStore:
    """Ids of words seen before; those that the last call had several times stay when it grows beyond ``KEPT_WORDS``."""

    def __init__(self, encode_words):
        self.encode_words = encode_words
        self.index = Numbered()
        self.ids = np.zeros(0, np.int32)
        self.counts = np.zeros(0, np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and how many each has."""
        number, old = self.index.__getitem__, len(self.index)
        flat: list[int] = []
        bounds = [0]
        for t in texts:
            flat.extend(map(number, words_of(t)))
            bounds.append(len(flat))
        which = np.array(flat, np.int64)
        del flat
        if len(self.index) > old:
            ids, counts = self.encode_words(list(islice(self.index, old, None)))
            self.ids, self.counts = np.concatenate([self.ids, ids]), np.concatenate([self.counts, counts])
        ids, n = gather(self.ids, self.counts, which)
        total = np.concatenate([[0], np.cumsum(n)])
        if len(self.index) > KEPT_WORDS:
            often = np.bincount(which, minlength=len(self.index))
            keep = often > max(1, np.partition(often, -KEPT_WORDS // 2)[-KEPT_WORDS // 2])
            self.ids, self.counts = gather(self.ids, self.counts, np.flatnonzero(keep))
            kept = compress(self.index, keep.tolist())
            self.index = Numbered(zip(kept, range(len(self.counts))))
        return ids, np.diff(total[np.array(bounds)])


def encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) to (doc_id, ids)."""
    store = WordStore(vocabulary(path).encode_words)
    for part in slices(batches, 1, CHUNK_BYTES):
        ids, counts = store.encode(part.column(1).to_pylist())
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(ids))
        yield pa.record_batch([part.column(0), lists], names=["doc_id", "ids"])


def decoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple]:
    """(doc_id, ids) to (doc_id, ids as an array, decoded text), one document at a time."""
    vocab = vocabulary(path)
    for batch in batches:
        lists = batch.column(1)
        values, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
        for doc_id, a, b in zip(batch.column(0).to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
            yield doc_id, values[a:b], vocab.decode(values[a:b])


def bpe_encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids of each row's whole text; null and empty texts have none. Rows that repeat are encoded each."""
    return plain(docs).mapInArrow(lambda batches: encoded(batches, path), ENCODED)


def bpe_decode(rows: DataFrame, path: str) -> DataFrame:
    """doc_id and text of rows with doc_id and ids. Null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            texts = [vocab.decode(np.array(x or [], np.int64)) for x in batch.column(1).to_pylist()]
            yield batch_from([batch.column(0), texts], "doc_id bigint, text string")

    return rows.select(rows["doc_id"], rows["ids"]).mapInArrow(run, "doc_id bigint, text string")


def bpe_round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Encodes, decodes what it has encoded, and returns digests of both: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Both steps run in one task, so that ids needn't be stored between them.
    """
    from hashlib import sha256

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decimal = np.array([str(i) for i in range(len(vocabulary(path).tokens))], object)
        for batch in encoded(batches, path):
            rows = [
                (doc_id, len(ids), sha256(" ".join(decimal[ids].tolist()).encode()).hexdigest(), sha256(text.encode()).hexdigest())
                for doc_id, ids, text in decoded(iter([batch]), path)
            ]
            yield batch_from(list(zip(*rows)), DIGESTS)

    return plain(docs).mapInArrow(run, DIGESTS)


DIGESTS = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
