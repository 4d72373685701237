"""Language-model scoring by prediction by partial matching (Cleary and Witten, 1984;
escape method D, with symbol exclusion).

A text is read as its lower-case words joined by one space and closed by a line feed. The byte-context trie
is pretrained on the training documents; a byte is coded in its longest known context, or escapes to the next shorter one, where the symbols
of the longer context are excluded, down to equal chances of all bytes. A document's
score is the log10 probability of its bytes.

The trie is never held whole. Documents are packed into chunks; each chunk sends its distinct
(context, byte) grams and words with training counts; counts are summed over the corpus, every distinct
gram gets its log probability, and each chunk gets back the values of its own grams and words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ship
from tidemark.session import materialize, scratch_path

ship(__name__)

# Bytes of context. A gram (context and byte) is a number below 2**(8 * ORDER + 8).
ORDER = 4
# Text bytes of a chunk, at which it is closed.
CHUNK_BYTES = 32_000_000
# Bytes whose grams are sorted at once.
BLOCK_BYTES = 250_000
# Ranges of keys in which the sorted blocks of a chunk are merged, one after the other.
PIECES = 16
# Rows of a batch that leaves a Python worker.
NEED_ROWS = 50_000
END = 0x0A
ALPHABET = 256
GRAM, WORD = 0, 1

LIDSTONE = 0.1  # c + 0.1 in the word baseline, fixed by its definition


def tokens_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def gram_keys(stream: np.ndarray, starts: np.ndarray, order: int = ORDER) -> np.ndarray:
    """The gram of every byte of ``stream``: the ``order`` bytes before it in its document
    (zero before the first) and the byte, as one number."""
    wide = stream.astype(np.uint64)
    keys = wide.copy()
    place = np.arange(len(stream)) - np.repeat(starts, np.diff(np.append(starts, len(stream))))
    for back in range(1, order + 1):
        keys[back:] |= np.where(place[back:] >= back, wide[:-back] << np.uint64(8 * back), np.uint64(0))
    return keys


def word_key(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word) - (1 << 63)




class ChunkBuilder:
    """Gathers documents and counts their words; holds their streams and no tokens."""

    def __init__(self, order: int):
        self.order = order
        self.ids: list[int | None] = []
        self.held: list[bool] = []
        self.streams: list[bytes] = []
        self.counts: dict[bytes, int] = {b"\n": 0}  # of training documents; other words with 0
        self.size = 0

    def add(self, ident: int | None, held: bool, text: str | None) -> None:
        ws = tokens_of(text)
        ws.append(b"\n")
        step = 0 if held else 1
        counts = self.counts
        for w in ws:
            counts[w] = counts.get(w, 0) + step
        ws.pop()
        stream = b" ".join(ws) + b"\n"
        self.ids.append(ident)
        self.held.append(held)
        self.streams.append(stream)
        self.size += len(stream)

    def clear(self) -> None:
        """Lets go of what the chunk's last rows do not need."""
        self.streams, self.counts = [], {}

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct grams of all documents with their counts in training documents."""
        seen_keys, seen_n = [], []
        for train in (True, False):
            part, size = [], 0
            chosen = [s for s, h in zip(self.streams, self.held) if h != train]
            for k, s in enumerate(chosen):
                part.append(s)
                size += len(s)
                if size >= BLOCK_BYTES or k == len(chosen) - 1:
                    raw = np.frombuffer(b"".join(part), dtype=np.uint8)
                    starts = np.concatenate([[0], np.cumsum([len(x) for x in part])[:-1]])
                    keys, n = np.unique(gram_keys(raw, starts, self.order), return_counts=True)
                    seen_keys.append(keys)
                    seen_n.append(n if train else np.zeros(len(keys), dtype=np.int64))
                    part, size = [], 0
                    # Blocks are merged as soon as they outgrow what is merged already.
                    if sum(len(x) for x in seen_keys[1:]) > max(len(seen_keys[0]), BLOCK_BYTES):
                        merged = _merged(seen_keys, seen_n)
                        seen_keys, seen_n = [merged[0]], [merged[1]]
        return _merged(seen_keys, seen_n)


def _merged(parts: list[np.ndarray], counts: list[np.ndarray], pieces: int = PIECES) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of sorted parts with their summed counts, a piece of the key range at a time, so
    that what is sorted and copied at once is a fraction of the parts."""
    longest = max(parts, key=len)
    bounds = longest[[len(longest) * p // pieces for p in range(1, pieces)]] if len(longest) else longest
    cuts = [np.concatenate([[0], np.searchsorted(k, bounds), [len(k)]]) for k in parts]
    keys, totals = [], []
    for p in range(len(bounds) + 1):
        k, inverse = np.unique(np.concatenate([x[c[p] : c[p + 1]] for x, c in zip(parts, cuts)]), return_inverse=True)
        n = np.concatenate([x[c[p] : c[p + 1]] for x, c in zip(counts, cuts)])
        keys.append(k)
        totals.append(np.bincount(inverse, weights=n, minlength=len(k)).astype(np.int64))
    return np.concatenate(keys), np.concatenate(totals)


def _chunk_rows(chunk: int, docs: ChunkBuilder):
    """The 'text' row of a chunk, then its 'need' rows, as Arrow batches of at most NEED_ROWS rows."""
    text = _text_row(chunk, docs)
    yield text
    word_keys = np.array([word_key(w) for w in docs.counts], dtype=np.int64)
    word_n = np.fromiter(docs.counts.values(), dtype=np.int64, count=len(docs.counts))
    keys, n = docs.grams()
    docs.clear()
    for kind, k, c in ((GRAM, keys.view(np.int64), n), (WORD, word_keys, word_n)):
        for at in range(0, len(k), NEED_ROWS):
            yield _need_rows(chunk, kind, k[at : at + NEED_ROWS], c[at : at + NEED_ROWS])


def _need_rows(chunk: int, kind: int, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    none = pa.nulls(len(keys))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(keys), chunk, np.int64)),
            pa.array(np.full(len(keys), kind, np.int32)),
            pa.array(keys),
            pa.array(n),
            none.cast(pa.list_(pa.int64())),
            none.cast(pa.list_(pa.bool_())),
            none.cast(pa.binary()),
            pa.array(np.full(len(keys), "need")),
        ],
        names=NAMES,
    )


def _text_row(chunk: int, docs: ChunkBuilder) -> pa.RecordBatch:
    blob = b"".join(docs.streams)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([chunk], pa.int64()),
            pa.array([None], pa.int32()),
            pa.array([None], pa.int64()),
            pa.array([None], pa.int64()),
            pa.array([docs.ids], pa.list_(pa.int64())),
            pa.array([docs.held], pa.list_(pa.bool_())),
            pa.array([zstandard.ZstdCompressor(level=3).compress(blob)], pa.binary()),
            pa.array(["text"]),
        ],
        names=NAMES,
    )


NAMES = ["chunk", "kind", "key", "n", "ids", "held", "blob", "part"]
CHUNK_SCHEMA = "chunk bigint, kind int, key bigint, n bigint, ids array<bigint>, held array<boolean>, blob binary, part string"


def pack_chunks(docs: DataFrame, order: int = ORDER, chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, DataFrame]:
    """Pack docs (doc_id, held_out, text) into stored chunks.

    Returns (texts, needs): one row per chunk with its ids and compressed streams, and
    (chunk, kind, key, n) for each distinct gram or word of the chunk, n counting training
    documents only. Both come from one pass and are written before use, so a chunk's
    number, made of the task's partition and a counter, never changes.
    """

    def run(batches):
        base, made = TaskContext.get().partitionId() << 32, 0
        docs_in = ChunkBuilder(order)
        for batch in batches:
            for i, h, t in zip(batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist(), batch.column("text")):
                docs_in.add(i, h, t.as_py())
                if docs_in.size >= chunk_bytes:
                    yield from _chunk_rows(base + made, docs_in)
                    docs_in, made = ChunkBuilder(order), made + 1
        if docs_in.ids:
            yield from _chunk_rows(base + made, docs_in)

    spark = docs.sparkSession
    path = scratch_path(spark, "ppm-chunks")
    rows = docs.select("doc_id", "held_out", "text").mapInArrow(run, CHUNK_SCHEMA)
    rows.write.partitionBy("part").option("compression", "zstd").parquet(path)
    # Two reads, so that the halves can be joined again without shared column ids.
    texts, needs = (spark.read.schema(CHUNK_SCHEMA).parquet(path).filter(F.col("part") == p) for p in ("text", "need"))
    return texts.select("chunk", "ids", "held", "blob"), needs.select("chunk", "kind", "key", "n")


class LowOrders:
    """Counts of orders 0 and 1 in full: at most 256 x 256 numbers."""

    def __init__(self, pairs: np.ndarray):
        self.n1 = pairs  # [context byte, byte]
        self.n0 = pairs.sum(axis=0)


def _suffix_stats(keys: np.ndarray, n: np.ndarray, order: int):
    """Distinct grams of one order with counts above zero, sorted; their contexts with total and distinct."""
    mask = np.uint64((1 << (8 * order + 8)) - 1)
    k, inverse = np.unique(keys & mask, return_inverse=True)
    c = np.bincount(inverse, weights=n, minlength=len(k))
    k, c = k[c > 0], c[c > 0]
    ctx, at = np.unique(k >> np.uint64(8), return_inverse=True)
    total = np.bincount(at, weights=c, minlength=len(ctx))
    distinct = np.bincount(at, minlength=len(ctx)).astype(np.float64)
    return k, c, ctx, total, distinct


def _find(sorted_keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """values at wanted keys, 0 where there is none."""
    if not len(sorted_keys):
        return np.zeros(len(wanted))
    at = np.minimum(np.searchsorted(sorted_keys, wanted), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == wanted, values[at], 0.0)


def ppm_log10(keys: np.ndarray, n: np.ndarray, low: LowOrders, order: int = ORDER) -> np.ndarray:
    """log10 probability of each distinct gram, given all grams that share its last
    two context bytes (order 2 and up) and the full counts of orders 1 and 0.

    At an order with training total T and D distinct symbols, after the longer context excluded
    symbols of total X and number E there, a symbol with count c has (c - 1/2) / (T - X), the
    escape (D - E) / 2 / (T - X). Longer contexts' symbols all occur in shorter ones, so
    the symbols of the next longer context are all that is excluded.
    """
    eight = np.uint64(8)
    levels: dict[int, tuple] = {}
    for j in range(order, 1, -1):
        levels[j] = _suffix_stats(keys, n, j)
    b1, s1 = np.nonzero(low.n1)
    c1 = low.n1[b1, s1].astype(np.float64)
    k1 = (b1.astype(np.uint64) << eight) | s1.astype(np.uint64)
    levels[1] = (k1, c1, np.arange(256, dtype=np.uint64), low.n1.sum(axis=1).astype(np.float64), (low.n1 > 0).sum(axis=1).astype(np.float64))
    s0 = np.flatnonzero(low.n0)
    levels[0] = (s0.astype(np.uint64), low.n0[s0].astype(np.float64), np.zeros(1, np.uint64), np.array([float(low.n0.sum())]), np.array([float(len(s0))]))
    logp = np.zeros(len(keys))
    open_ = np.arange(len(keys))  # grams still escaping
    gone_total, gone_distinct = np.zeros(len(keys)), np.zeros(len(keys))
    for j in range(order, -1, -1):
        if not len(open_):
            break
        k, c, ctx, total, distinct = levels[j]
        want = keys[open_] & np.uint64((1 << (8 * j + 8)) - 1)
        here = want >> eight
        t = _find(ctx, total, here) - gone_total[open_]
        d = _find(ctx, distinct, here) - gone_distinct[open_]
        count = _find(k, c, want)
        hit = count > 0
        full = _find(ctx, distinct, here) >= ALPHABET  # nothing is left to escape to
        share = np.where(hit, np.where(full, count, count - 0.5), 0.5 * d)
        logp[open_] += np.where(d > 0, np.log10(np.where(d > 0, share, 1.0) / np.where(d > 0, t, 1.0)), 0.0)
        # What the context here excludes one order down: its symbols' counts there.
        if j > 0:
            kl, cl = levels[j - 1][:2]
            shorter = _find(kl, cl, k & np.uint64((1 << (8 * j)) - 1))
            at = np.searchsorted(ctx, k >> eight)
            excluded = np.bincount(at, weights=shorter, minlength=len(ctx)) if len(k) else np.zeros(len(ctx))
            open_, here = open_[~hit], here[~hit]
            gone_total[open_] = _find(ctx, excluded, here)
            gone_distinct[open_] = _find(ctx, distinct, here)
        else:
            open_ = open_[~hit]
    if len(open_):
        logp[open_] -= np.log10(ALPHABET - len(s0))
    return logp


def gram_values(grams: DataFrame, order: int = ORDER) -> DataFrame:
    """(key, value): log10 probability of every distinct gram of (key, n).

    Grams are grouped by their last two context bytes, at most 65,536 groups of at most
    256 ** (order - 1) grams whatever the corpus; orders 1 and 0, 65,536 counts, go to all tasks.
    """
    spark = grams.sparkSession
    pair = F.col("key").bitwiseAND(F.lit(0xFFFF))
    rows = grams.filter("n > 0").groupBy(pair.alias("pair")).agg(F.sum("n").alias("n")).collect()
    pairs = np.zeros((256, 256))
    for r in rows:
        pairs[r["pair"] >> 8, r["pair"] & 0xFF] = r["n"]
    shared = spark.sparkContext.broadcast(pairs)

    def run(table: pa.Table) -> pa.Table:
        keys = table.column("key").to_numpy().astype(np.uint64)
        logp = ppm_log10(keys, table.column("n").to_numpy().astype(np.float64), LowOrders(shared.value), order)
        return pa.table({"key": table.column("key"), "value": pa.array(logp)})

    context = F.shiftright("key", 8).bitwiseAND(F.lit(0xFFFF))
    return grams.groupBy(context.alias("context")).applyInArrow(run, "key bigint, value double")


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_col: str | None = None, order: int = ORDER, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row.

    Training documents are those whose crc32(doc_id as text) mod 10 is not 0 (a null id counts as the empty
    text), or those whose ``held_col`` is false. A null text counts as empty and has one token, the end.
    ``base_score`` is the add-0.1 word unigram model's, ``score`` the PPM model's log10 probability. Without
    any training document both are those of empty models. Words are counted under a 64-bit hash.
    """
    spark = docs.sparkSession
    ident = F.col(f"`{id_col}`").cast("bigint")
    remainder = F.crc32(F.encode(F.coalesce(ident.cast("string"), F.lit("")), "UTF-8")) % 10
    held = F.coalesce(F.col(f"`{held_col}`"), F.lit(False)) if held_col else remainder == 0
    base = docs.select(ident.alias("doc_id"), held.alias("held_out"), F.col(f"`{text_col}`").cast("string").alias("text"))
    texts, needs = pack_chunks(base, order, chunk_bytes)
    grams, words = (needs.filter(F.col("kind") == k).select("chunk", "key", "n") for k in (GRAM, WORD))
    totals = materialize(grams.groupBy("key").agg(F.sum("n").alias("n")), "ppm-totals")
    values = materialize(gram_values(totals, order), "ppm-values")
    of_key = Window.partitionBy("key")
    given = grams.join(values, "key").select(
        "chunk", F.lit(GRAM).alias("kind"), "key", "value", F.lit(False).alias("first")
    ).unionByName(
        words.select(
            "chunk",
            F.lit(WORD).alias("kind"),
            "key",
            F.sum("n").over(of_key).cast("double").alias("value"),
            (F.min("chunk").over(of_key) == F.col("chunk")).alias("first"),
        )
    )

    def run(key, text: pa.Table, got: pa.Table) -> pa.Table:
        kinds, keys, vals = (got.column(c).to_numpy() for c in ("kind", "key", "value"))
        # Words that no earlier chunk counts: summed over the chunks, the corpus vocabulary.
        fresh = int((got.column("first").to_numpy(zero_copy_only=False) & (vals > 0) & (kinds == WORD)).sum())
        gram_keys_, gram_vals = keys[kinds == GRAM].astype(np.uint64), vals[kinds == GRAM]
        at = np.argsort(gram_keys_)
        gram_keys_, gram_vals = gram_keys_[at], gram_vals[at]
        counts = dict(zip(keys[kinds == WORD].tolist(), vals[kinds == WORD].tolist()))
        out = []
        for ids, held_out, blob in zip(text.column("ids").to_pylist(), text.column("held").to_pylist(), text.column("blob").to_pylist()):
            out.append(_score_chunk(ids, held_out, zstandard.ZstdDecompressor().decompress(blob), gram_keys_, gram_vals, counts, fresh))
        return pa.concat_tables(out)

    def _score_chunk(ids, held_out, stream, gram_keys_, gram_vals, counts, fresh) -> pa.Table:
        raw = np.frombuffer(stream, dtype=np.uint8)
        stops = np.flatnonzero(raw == END) + 1
        starts = np.concatenate([[0], stops[:-1]])
        score = np.zeros(len(ids))
        first = 0
        while first < len(ids):  # blocks of documents, at least one
            last = max(first + 1, int(np.searchsorted(stops, starts[first] + BLOCK_BYTES // 2, side="right")))
            part = raw[starts[first] : stops[last - 1]]
            begin = starts[first:last] - starts[first]
            keys, inverse = np.unique(gram_keys(part, begin, order), return_inverse=True)
            logp = gram_vals[np.searchsorted(gram_keys_, keys)][inverse]
            score[first:last] = np.add.reduceat(logp, begin)
            first = last
        memo: dict[bytes, float] = {}
        n, known, base_score = [], [], []
        for line in stream.split(b"\n")[:-1]:
            ws = line.split(b" ") if line else []
            ws.append(b"\n")
            c = []
            for w in ws:
                v = memo.get(w)
                if v is None:
                    v = memo[w] = counts[word_key(w)]
                c.append(v)
            a = np.array(c)
            n.append(len(ws))
            known.append(int((a > 0).sum()))
            base_score.append(float(np.log10(a + LIDSTONE).sum()))
        return pa.table(
            {
                "doc_id": pa.array(ids, pa.int64()),
                "held_out": pa.array(held_out, pa.bool_()),
                "n_tokens": pa.array(n, pa.int64()),
                "n_known": pa.array(known, pa.int64()),
                "base_sum": pa.array(base_score, pa.float64()),
                "score": pa.array(score),
                "fresh": pa.array([fresh] + [0] * (len(ids) - 1), pa.int64()),
            }
        )

    schema = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_sum double, score double, fresh bigint"
    scored = materialize(texts.groupBy("chunk").cogroup(given.groupBy("chunk")).applyInArrow(run, schema), "ppm-scores")
    n_train = int(words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    n_distinct = int(scored.agg(F.coalesce(F.sum("fresh"), F.lit(0))).first()[0])
    per_token = float(np.log10(n_train + LIDSTONE * (n_distinct + 1)))
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(n_train).cast("bigint").alias("train_tokens"),
        (F.col("base_sum") - F.col("n_tokens") * F.lit(per_token)).alias("base_score"),
        "score",
    )
