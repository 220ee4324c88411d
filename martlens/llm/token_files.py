"""Token ids in a compact binary file format, and back.

A file is the ids of a range of documents in ascending doc_id order.  It is a
sequence of segments; a segment holds whole documents and is one record:

    doc_ids, lengths    the documents and their numbers of ids
    symbols, freqs      one frequency table for the segment, summing to 2**16
    states              per block: LANES start states of the decoder
    sizes, crcs         per block: 16-bit words that follow, checksum of its ids
    words               the blocks' streams, one after another

A block is BLOCK_IDS ids (the last one of a segment may be shorter), coded on
its own by a range asymmetric numeral system with LANES interleaved states.
``states`` and ``sizes`` are the checkpoints from which any block can be
decoded alone; here numpy steps all blocks of a segment together.  Records are
stored with Spark's Parquet writer, so a lost task leaves no half file.

Edge cases: a null or empty text is the end id alone; rows with a null id come
first; repeated rows keep their places next to each other; one very long document makes one long segment; an
empty table gives no rows; other columns are ignored.  A block whose checksum
differs after decoding raises an error.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martlens.llm.spans import U64, blocks, tidy
from martlens.llm.store import Workspace, partitions
from martlens.llm.word_bpe import WordBpe, vocabulary_path

SCALE_BITS = 16
LANES = 32
BLOCK_IDS = LANES * 2048
SEGMENT_IDS = 1 << 20

SEGMENT = pa.schema([("file", pa.int32()), ("segment", pa.int32()), ("n_tokens", pa.int64()),
                     *((c, pa.binary()) for c in ("doc_ids", "lengths", "symbols", "freqs", "states", "sizes",
                                                  "crcs", "words"))])
SEGMENT_DDL = ("file int, segment int, n_tokens long, doc_ids binary, lengths binary, symbols binary, "
               "freqs binary, states binary, sizes binary, crcs binary, words binary")


def quantise(counts: np.ndarray, bits: int = SCALE_BITS) -> np.ndarray:
    """Frequencies of at least 1 that sum to 2**bits, near in proportion."""
    total = 1 << bits
    if len(counts) > total:
        raise ValueError("more symbols than the frequency scale has room for")
    freq = np.maximum(1, counts * total // counts.sum())
    surplus = int(freq.sum()) - total
    order = np.argsort(-freq, kind="stable")
    if surplus < 0:
        freq[order[0]] -= surplus
    while surplus > 0:                  # take back from the largest, as much as they can spare
        for i in order:
            take = min(surplus, int(freq[i]) - 1, max(1, int(freq[i]) // 2))
            freq[i] -= take
            surplus -= take
            if not surplus:
                break
    return freq


def _encode_blocks(symbols: np.ndarray, freq: np.ndarray, cum: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Start states and word streams of blocks of equal length (block, step, lane)."""
    n, steps, lanes = symbols.shape
    state = np.full((n, lanes), 1 << 16, U64)
    owners, emitted = [], []
    for t in range(steps - 1, -1, -1):
        s = symbols[:, t, :]
        f = freq[s]
        full = state >= (f << U64(32 - SCALE_BITS))
        b, lane = np.nonzero(full)
        owners.append(b)
        emitted.append((state[b, lane] & U64(0xFFFF)).astype(np.uint16))
        state[b, lane] >>= U64(16)
        q, r = np.divmod(state, f)
        state = (q << U64(SCALE_BITS)) + r + cum[s]
    owner = np.concatenate(owners[::-1])
    words = np.concatenate(emitted[::-1])
    order = np.argsort(owner, kind="stable")
    return state.astype(np.uint32), np.split(words[order], np.searchsorted(owner[order], np.arange(1, n)))


def _decode_blocks(states: np.ndarray, sizes: np.ndarray, words: np.ndarray, steps: int,
                   freq: np.ndarray, cum: np.ndarray, table: np.ndarray) -> np.ndarray:
    state = states.astype(U64)
    at = np.cumsum(sizes) - sizes
    padded = np.append(words, np.uint16(0)).astype(U64)
    out = np.empty((len(states), steps, states.shape[1]), np.uint32)
    for t in range(steps):
        slot = state & U64((1 << SCALE_BITS) - 1)
        s = table[slot]
        out[:, t, :] = s
        state = freq[s] * (state >> U64(SCALE_BITS)) + slot - cum[s]
        low = state < U64(1 << 16)
        rank = np.cumsum(low, axis=1)
        b, lane = np.nonzero(low)
        state[b, lane] = (state[b, lane] << U64(16)) | padded[at[b] + rank[b, lane] - 1]
        at += rank[:, -1]
    return out


def _parts(n: int) -> list[tuple[int, int, int]]:
    """(first id, blocks, steps) of the full blocks and of the short last one."""
    full, rest = divmod(n, BLOCK_IDS)
    out = [(0, full, BLOCK_IDS // LANES)] if full else []
    return out + ([(full * BLOCK_IDS, 1, -(-rest // LANES))] if rest else [])


def encode_segment(ids: np.ndarray) -> dict[str, bytes]:
    names, coded, counts = np.unique(ids, return_inverse=True, return_counts=True)
    freq = quantise(counts)
    f, cum = freq.astype(U64), (np.cumsum(freq) - freq).astype(U64)
    pad = int(counts.argmax())
    states, sizes, crcs, streams = [], [], [], []
    for first, n, steps in _parts(len(ids)):
        cells = np.full(n * steps * LANES, pad, np.int64)
        part = coded[first:first + len(cells)]
        cells[:len(part)] = part
        state, words = _encode_blocks(cells.reshape(n, steps, LANES), f, cum)
        states.append(state)
        sizes += [len(w) for w in words]
        streams += words
        size = steps * LANES
        crcs += [zlib.crc32(ids[i:i + size].astype("<u4")) for i in range(first, first + len(part), size)]
    return {"symbols": zlib.compress(np.diff(names, prepend=0).astype("<u4").tobytes()),
            "freqs": zlib.compress(freq.astype("<u4").tobytes()),
            "states": np.concatenate(states).astype("<u4").tobytes(),
            "sizes": np.array(sizes, "<u4").tobytes(), "crcs": np.array(crcs, "<u4").tobytes(),
            "words": np.concatenate(streams).astype("<u2").tobytes()}


def decode_segment(n: int, record: dict[str, bytes]) -> np.ndarray:
    names = np.cumsum(np.frombuffer(zlib.decompress(record["symbols"]), "<u4"))
    freq = np.frombuffer(zlib.decompress(record["freqs"]), "<u4").astype(np.int64)
    table = np.repeat(np.arange(len(freq)), freq)
    f, cum = freq.astype(U64), (np.cumsum(freq) - freq).astype(U64)
    states = np.frombuffer(record["states"], "<u4").reshape(-1, LANES)
    sizes = np.frombuffer(record["sizes"], "<u4").astype(np.int64)
    crcs = np.frombuffer(record["crcs"], "<u4")
    words = np.frombuffer(record["words"], "<u2")
    out, block, word = np.empty(n, np.uint32), 0, 0
    for first, count, steps in _parts(n):
        size = sizes[block:block + count]
        cells = _decode_blocks(states[block:block + count], size, words[word:word + int(size.sum())], steps,
                               f, cum, table).reshape(-1)
        take = min(n - first, len(cells))
        out[first:first + take] = names[cells[:take]]
        for i in range(count):
            lo = first + i * steps * LANES
            if zlib.crc32(out[lo:lo + steps * LANES].astype("<u4")) != crcs[block + i]:
                raise ValueError("a block of a token file does not have its checksum")
        block, word = block + count, word + int(size.sum())
    return out


def write_token_files(docs: DataFrame, path: str, ws: Workspace, tasks: int,
                      segment_ids: int = SEGMENT_IDS) -> DataFrame:
    """Encode all documents in doc_id order; returns the stored segments."""
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, file = WordBpe.load(path), TaskContext.get().partitionId()
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        count = segment = 0

        def flush() -> pa.RecordBatch:
            nulls = sum(h[0].null_count for h in held)      # null ids come first
            doc_ids = np.concatenate([h[0].fill_null(0).to_numpy() for h in held])
            lengths, ids = (np.concatenate([h[k] for h in held]) for k in (1, 2))
            header = np.append(nulls, np.diff(doc_ids, prepend=0)).astype("<i8")
            record = encode_segment(ids) | {"doc_ids": zlib.compress(header.tobytes()),
                                            "lengths": zlib.compress(lengths.astype("<u4").tobytes())}
            row = [file, segment, len(ids), *(record[c.name] for c in list(SEGMENT)[3:])]
            return pa.RecordBatch.from_arrays([pa.array([v], c.type) for v, c in zip(row, SEGMENT, strict=True)],
                                              schema=SEGMENT)

        for batch in batches:
            for rows, raw, off in blocks(batch):
                ids, bounds = encoder.encode(raw, off)
                held.append((rows.column(0).cast(pa.int64()), np.diff(bounds), ids))
                count += len(ids)
                if count >= segment_ids:
                    yield flush()
                    held, count, segment = [], 0, segment + 1
        if count:
            yield flush()

    ordered = (docs.select("doc_id", "text")
               # rows that share an id, or have none, may fill several files
               .repartitionByRange(tasks, "doc_id", F.substring("text", 1, 64), F.monotonically_increasing_id())
               .sortWithinPartitions("doc_id", "text"))
    return ws.save(ordered.mapInArrow(run, SEGMENT_DDL), "segments", compression="none")


READ = pa.schema([("file", pa.int32()), ("segment", pa.int32()), ("doc_id", pa.int64()), ("before", pa.int64()),
                  ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def read_token_files(segments: DataFrame) -> DataFrame:
    """Decode stored segments: per document its ids before it in the segment,
    its number of ids and their checksum."""
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = {c: batch.column(j)[i].as_py() for j, c in enumerate(batch.schema.names)}
                ids = decode_segment(r["n_tokens"], r).astype("<u4")
                nulls, *steps = np.frombuffer(zlib.decompress(r["doc_ids"]), "<i8").tolist()
                doc_ids = np.cumsum(np.array(steps, np.int64))
                lengths = np.frombuffer(zlib.decompress(r["lengths"]), "<u4").astype(np.int64)
                before = np.cumsum(lengths) - lengths
                crc = [zlib.crc32(ids[a:a + n]) for a, n in zip(before.tolist(), lengths.tolist(), strict=True)]
                k = len(doc_ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(k, r["file"], np.int32)), pa.array(np.full(k, r["segment"], np.int32)),
                     pa.array(doc_ids, mask=np.arange(k) < nulls), pa.array(before), pa.array(lengths), pa.array(crc, pa.int64())], schema=READ)

    return segments.mapInArrow(run, "file int, segment int, doc_id long, before long, n_tokens long, ids_crc32 long")


def segment_starts(segments: DataFrame) -> DataFrame:
    """(file, segment, start): ids in all segments before, from the sizes of
    the files (as many rows as the job has tasks) and of a file's segments."""
    sizes = segments.select("file", "segment", "n_tokens")
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = sizes.groupBy("file").agg(F.sum("n_tokens").alias("n")).select(
        "file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("file_start"))
    inside = Window.partitionBy("file").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    return (sizes.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
            .join(files, "file").select("file", "segment", (F.col("file_start") + F.col("inside")).alias("first")))


def op8_token_files(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Every document as read back from the written token files."""
    segments = write_token_files(docs, vocabulary_path(), Workspace(spark, "token-files"), partitions(spark))
    return read_token_files(segments).join(segment_starts(segments), ["file", "segment"]).select(
        "doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
