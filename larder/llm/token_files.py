"""Token ids in binary files, packed by Simple-8b.

A 64-bit word has a selector in its top four bits and 60 bits for as many equally wide ids as the selector says. Selector
0 is the escape: the next word holds one value of up to 64 bits. Blocks of a fixed number of ids start on a word of their
own, and the file lists their offsets, so that a reader decodes any block without those before it.

File, little endian: magic, counts (documents, ids, words, blocks), document ids, their null flags, ids of each
document, first word of each block and the end, words.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.bpe import CHUNK_BYTES, WordStore, byte_letters
from larder.llm.tables import batch_from, batch_of, checkpointed, plain, slices, width
from larder.session import run_dir

MAGIC = b"S8BTOK01"
BLOCK = 4096
SHARD_IDS = 4_000_000
# Fixed values of the coding: ids in a word and bits of each, for the selectors from 1 on.
SELECTORS = [
    (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60),
]
MANIFEST = "part int, seq int, path string, n_docs bigint, n_ids bigint, n_bytes bigint"


def pack(values: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Words and the first word of each block, with the end as last entry."""
    values = np.asarray(values, np.uint64)
    n = len(values)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(1, np.uint64)
    left = np.minimum(block - np.arange(n) % block, n - np.arange(n))
    need = np.searchsorted(np.array([1 << b for b in range(64)], np.uint64), values, "right").astype(np.uint8)  # bits of each
    choice = np.zeros(n, np.int8)  # the first selector, thus the one with most ids, that fits
    for k, (count, bits) in reversed(list(enumerate(SELECTORS, 1))):
        # Whether the next ``count`` values are small, by doubling the stretch that is.
        fits = need <= bits
        if count > 1:
            reach = 1
            while reach < count and fits.any():
                step = min(reach, count - reach)
                fits[:-step] &= fits[step:]
                fits[-step:] = False
                reach += step
            fits &= left >= count
        choice[fits] = k
    steps = np.array([1] + [c for c, _ in SELECTORS], np.int64)[choice].tolist()
    heads, at = [], 0
    while at < n:
        heads.append(at)
        at += steps[at]
    heads = np.array(heads, np.int64)
    chosen = choice[heads]
    size = 1 + (chosen == 0)  # an escape takes two words
    first = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    for k, (count, bits) in enumerate(SELECTORS, 1):
        of = np.flatnonzero(chosen == k)
        word = np.full(len(of), k << 60, np.uint64)
        for j in range(count):
            word |= values[heads[of] + j] << np.uint64(j * bits)
        words[first[of]] = word
    words[first[chosen == 0] + 1] = values[heads[chosen == 0]]
    starts = first[np.searchsorted(heads, np.arange(0, n, block))]
    return words, np.concatenate([starts, [len(words)]]).astype(np.uint64)


def unpack(words: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` values of words that begin at a block and end at one."""
    words = np.asarray(words, np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    # A word after an escape is raw, whatever its top bits look like; escapes chain only over raw words.
    raw = np.zeros(len(words), bool)
    for i in np.flatnonzero(selector == 0).tolist():
        if not raw[i] and i + 1 < len(words):
            raw[i + 1] = True
    head = np.flatnonzero(~raw)
    count = np.array([1] + [c for c, _ in SELECTORS] + [0], np.int64)[selector[head]]
    first = np.cumsum(count) - count
    out = np.empty(n, np.uint64)
    for k, (c, bits) in enumerate(SELECTORS, 1):
        of = np.flatnonzero(selector[head] == k)
        mask = np.uint64((1 << bits) - 1)
        for j in range(c):
            out[first[of] + j] = (words[head[of]] >> np.uint64(j * bits)) & mask
    of = np.flatnonzero(selector[head] == 0)
    out[first[of]] = words[head[of] + 1]
    return out


def to_file(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray) -> bytes:
    words, starts = pack(ids)
    null = np.array([d is None for d in doc_ids], np.uint8)
    return b"".join([
        MAGIC,
        np.array([len(doc_ids), len(ids), len(words), len(starts) - 1], "<u8").tobytes(),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        null.tobytes(),
        np.asarray(counts, "<u4").tobytes(),
        starts.astype("<u8").tobytes(),
        words.astype("<u8").tobytes(),
    ])


class TokenFile:
    """What ``to_file`` wrote. ``ids(a, b)`` decodes only the blocks that hold those ids."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a token file")
        self.n_docs, self.n_ids, n_words, n_blocks = np.frombuffer(data, "<u8", 4, 8).astype(int).tolist()
        at = 40
        ids = np.frombuffer(data, "<i8", self.n_docs, at).tolist()
        at += 8 * self.n_docs
        null = np.frombuffer(data, np.uint8, self.n_docs, at).tolist()
        at += self.n_docs
        self.doc_ids = [None if z else d for d, z in zip(ids, null)]
        self.counts = np.frombuffer(data, "<u4", self.n_docs, at).astype(np.int64)
        at += 4 * self.n_docs
        self.starts = np.frombuffer(data, "<u8", n_blocks + 1, at).astype(np.int64)
        at += 8 * (n_blocks + 1)
        self.words = np.frombuffer(data, "<u8", n_words, at)

    def ids(self, a: int = 0, b: int | None = None) -> np.ndarray:
        b = self.n_ids if b is None else b
        if a >= b:
            return np.zeros(0, np.uint64)
        low, high = a // BLOCK, -(-b // BLOCK)
        held = min(high * BLOCK, self.n_ids) - low * BLOCK
        found = unpack(self.words[self.starts[low] : self.starts[high]], held)
        return found[a - low * BLOCK : b - low * BLOCK]


# Printable ASCII without apostrophes, and Latin letters with at most one comma or full stop behind: for these words lower
# case and splitting are plain, and the library's model can be asked directly. All others go through the whole library.
ASCII_PIECES = re.compile("[a-z]+|[0-9]|[^a-z0-9]+").findall
LATIN = re.compile("([A-Za-zÀ-ÖØ-öø-įı-ɏ]+)([.,]?)")


@lru_cache(2)
def library_words(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    tokenize, letters = tokenizer.model.tokenize, dict(enumerate(byte_letters()))
    cores: dict[str, list[int]] = {}

    def core_ids(core: str) -> list[int]:
        shown = core if core.isascii() else core.encode().decode("latin-1").translate(letters)
        found = cores[core] = [t.id for t in tokenize(shown)]
        return found

    def encode_words(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(cores) > CACHED_CORES:
            cores.clear()
        found: list = [None] * len(words)
        rest, known, latin = [], cores.get, LATIN.fullmatch
        for k, word in enumerate(words):
            if word.isascii() and word.isprintable() and "'" not in word and "<|" not in word:
                if word.isalpha():
                    found[k] = known(low := word.lower()) or core_ids(low)
                else:
                    found[k] = [i for p in ASCII_PIECES(word.lower()) for i in known(p) or core_ids(p)]
                continue
            if m := latin(word):
                core, stop = m[1].lower(), m[2]
            else:
                rest.append(k)
                continue
            ids = known(core) or core_ids(core)
            found[k] = ids + (known(stop) or core_ids(stop)) if stop else ids
        for k, e in zip(rest, tokenizer.encode_batch([words[k] for k in rest], add_special_tokens=False)):
            found[k] = e.ids
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.array(list(chain.from_iterable(found)), np.int32), counts

    return encode_words


CACHED_CORES = 300_000


def write_token_files(docs: DataFrame, path: str, end_id: int, folder: str | None = None, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encodes whole texts and writes them in ascending order of doc_id (null ids first); returns the manifest.

    Each document's ids end with ``end_id``. A task names its files anew at each attempt, and only files of the manifest
    are ever read, so a repeated task does no harm. Null and empty texts have the end id alone.
    """
    spark = docs.sparkSession
    folder = folder or run_dir(spark, "tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, part = WordStore(library_words(path)), TaskContext.get().partitionId()
        system, root = fs.FileSystem.from_uri(folder)
        held: list[tuple] = []
        n, seq = 0, 0

        def flush():
            doc_ids = [d for names, _, _ in held for d in names]
            data = to_file(doc_ids, np.concatenate([c for _, c, _ in held]), np.concatenate([i for _, _, i in held]))
            name = f"part-{part:06d}-{seq:05d}-{uuid.uuid4().hex}.s8b"
            with system.open_output_stream(f"{root}/{name}") as out:
                out.write(data)
            return batch_of([(part, seq, name, len(doc_ids), n, len(data))], MANIFEST)

        system.create_dir(root, recursive=True)
        for piece in slices(batches, 1, CHUNK_BYTES // 2):
            ids, counts = store.encode(piece.column(1).to_pylist())
            held.append((piece.column(0).to_pylist(), counts + 1, with_end(ids, counts, end_id)))
            n += len(held[-1][2])
            if n >= shard_ids:
                yield flush()
                held, n, seq = [], 0, seq + 1
        if held:
            yield flush()

    ordered = plain(docs).repartitionByRange(width(spark), "doc_id").sortWithinPartitions("doc_id", "text")
    manifest = checkpointed(ordered.mapInArrow(run, MANIFEST))
    return manifest.withColumn("path", F.concat(F.lit(f"{folder}/"), "path"))


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> np.ndarray:
    out = np.full(len(ids) + len(counts), end_id, np.int32)
    keep = np.ones(len(out), bool)
    keep[np.cumsum(counts + 1) - 1] = False
    out[keep] = ids
    return out


def read_token_files(manifest: DataFrame, rows_of, ddl: str) -> DataFrame:
    """``rows_of(file, start)`` for each file, ``start`` being the ids in all files before it.

    The running total needs one row per file; files have millions of ids.
    """
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for r in batch.to_pylist():
                system, name = fs.FileSystem.from_uri(r["path"])
                with system.open_input_file(name) as f:
                    yield batch_from(rows_of(TokenFile(f.read()), r["start"]), ddl)

    return files.repartition(width(manifest.sparkSession), "path").select("path", "start").mapInArrow(run, ddl)


DIGESTS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def digests(file: TokenFile, start: int) -> list:
    """Columns doc_id, start, n_tokens, ids_crc32 of a file's documents, decoded block by block."""
    ends = np.cumsum(file.counts)
    crcs: list[int] = []
    step = 64 * BLOCK
    held, at = np.zeros(0, "<u4"), 0  # ids from position ``at`` on that no finished document has
    for begin in range(0, max(file.n_ids, 1), step):
        held = np.concatenate([held, file.ids(begin, min(begin + step, file.n_ids)).astype("<u4")])
        while len(crcs) < file.n_docs and ends[len(crcs)] <= at + len(held):
            k = int(ends[len(crcs)]) - at
            crcs.append(zlib.crc32(held[:k].tobytes()))
            held, at = held[k:], at + k
    return [file.doc_ids, start + ends - file.counts, file.counts, crcs]


def token_file_digests(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """Writes token files and reads them back: doc_id, start, n_tokens, ids_crc32."""
    return read_token_files(write_token_files(docs, path, end_id), digests, DIGESTS)
