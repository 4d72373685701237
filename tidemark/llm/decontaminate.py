"""Benchmark decontamination: rare word pairs join training texts to test items,
then Smith-Waterman alignment scores exact, edited and paraphrased copies.

An alignment of M matches in r runs scores at most 2 M - (r - 1) and covers M - r pairs of neighbouring words of the item, and M is at
most the item's length L. So one that reaches the share s of 2 L covers at least need = (2 s - 1) L - 1 pairs, wherever its
edits lie. Any n - need + 1 of an item's n pairs therefore hold one that the copy covers: the ones that are rarest in the
corpus are the item's seeds. A text that has a seed of an item is counted against all its pairs, and only with
``need`` of them aligned, within the stretch that an alignment through a shared pair can reach. No copy over the threshold is lost
on the way. Items so short that need is 0 have single words in place of pairs, of which a copy has at least s L.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import ship, store_texts
from tidemark.session import materialize

ship(__name__)

MATCH, MISMATCH, GAP = 2, -1, -1
# Share of the item's own score from which a document counts as contaminated.
MIN_SCORE = 0.6
# A document counts as contaminated as well if it has so many words of an item in a row, however long the item.
VERBATIM_WORDS = 25
MEMO_WORDS = 500_000
# Item grams are broadcast up to this many (32 bytes each); beyond it they are joined by shuffle.
BROADCAST_GRAMS = 2_000_000
# Candidate documents' keys are broadcast up to this many (8 bytes each); beyond it all texts are shuffled.
BROADCAST_KEYS = 4_000_000
# Texts are hashed in blocks of neighbouring ones of up to so many bytes, and met with items in blocks of so many (gram, item).
BLOCK_BYTES = 1 << 20
BLOCK_GRAMS = 1 << 18
# Words longer than this many bytes are hashed one by one.
LONG_WORD = 512

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MARKS = b".,;:!?\"'()[]{}"
# By a number of bytes: the bits that so many bytes fill, of eight.
_FILLED = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)


def words_of(text: str | None) -> list[bytes]:
    """Words without ASCII white space, A-Z as a-z, without marks at either end."""
    ws = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return [w.strip(_MARKS) or w for w in ws]


def _blocks(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring rows whose sizes add up to at most ``most``; a larger row is a range of its own."""
    ends, lo = np.cumsum(sizes), 0
    while lo < len(sizes):
        before = int(ends[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield lo, hi
        lo = hi


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(29)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(32)


def hash_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts in turn, as ``words_of`` gives them, and where each text's begin, then the end.

    Eight bytes of all words are mixed in at once, so the cost does not depend on how many different words there are.
    """
    # Cast only after the first function: Arrow misreads a slice that has been cast.
    lower = pc.ascii_lower(pc.fill_null(texts, "")).cast(pa.large_string())
    split = pc.ascii_split_whitespace(lower)
    whole = split.values
    filled = pc.greater(pc.binary_length(whole), 0)
    # Text that begins or ends in white space has an empty string there.
    begin = np.concatenate([[0], np.cumsum(filled.to_numpy(zero_copy_only=False))])[split.offsets.to_numpy()]
    if begin[-1] < len(whole):
        whole = whole.filter(filled)
    words = pc.ascii_trim(whole, characters=_MARKS.decode())
    bare = pc.equal(pc.binary_length(words), 0)
    if pc.any(bare).as_py():
        words = pc.if_else(bare, whole, words)
    if not len(words):
        return np.zeros(0, dtype=np.uint64), begin
    _, edges, data = words.buffers()
    edges = np.frombuffer(edges, dtype=np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.concatenate([np.frombuffer(data, dtype=np.uint8), np.zeros(8, dtype=np.uint8)])
    eight = np.ndarray(len(data) - 7, dtype="<u8", buffer=data, strides=(1,))
    at, size = edges[:-1], np.diff(edges)
    h = _mixed(size.astype(np.uint64) * _MIX ^ eight[at] & _FILLED[np.minimum(size, 8)])
    done, more = 8, np.flatnonzero((size > 8) & (size <= LONG_WORD))
    while len(more):
        h[more] = _mixed(h[more] * _MIX ^ eight[at[more] + done] & _FILLED[np.minimum(size[more] - done, 8)])
        done += 8
        more = more[size[more] > done]
    for k in np.flatnonzero(size > LONG_WORD).tolist():
        h[k] = xxhash.xxh64_intdigest(data[edges[k] : edges[k + 1]])
    return h, begin


def _hashed(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First and last (exclusive) row of blocks of texts, with ``hash_words`` of these."""
    for lo, hi in _blocks(pc.fill_null(pc.binary_length(texts), 0).to_numpy(), BLOCK_BYTES):
        yield lo, hi, *hash_words(texts.slice(lo, hi - lo))


class GramSet:
    """Distinct grams to look others up in: a table by the last bits spares most others the search."""

    def __init__(self, grams: np.ndarray):
        self.grams, self.counts = np.unique(grams, return_counts=True)
        bits = min(max((64 * len(self.grams)).bit_length(), 10), 24)
        self.last = self.grams.dtype.type((1 << bits) - 1)
        self.table = np.zeros(1 << bits, dtype=bool)
        self.table[self.grams & self.last] = True

    def places(self, grams: np.ndarray) -> np.ndarray:
        """Places of those ``grams`` that are in the set."""
        at = np.flatnonzero(self.table[grams & self.last])
        near = np.minimum(np.searchsorted(self.grams, grams[at]), len(self.grams) - 1)
        return at[self.grams[near] == grams[at]]


class Hasher:
    """64-bit hashes of the grams of a text from those of its words."""

    @staticmethod
    def pairs(h: np.ndarray) -> np.ndarray:
        out = (h[:-1] * _MIX + h[1:]) * _MIX
        return (out ^ out >> np.uint64(29)).view(np.int64)

    @staticmethod
    def singles(h: np.ndarray) -> np.ndarray:
        return (h * _MIX ^ np.uint64(0xD6E8FEB86659FD93)).view(np.int64)


def align(doc: np.ndarray, item: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment of two id sequences: score, start and end (exclusive) in doc.

    Linear gap costs let a whole row be computed at once: gaps along the row are a running
    maximum. The start is the end of the same alignment of the reversed sequences.
    """
    score, end = _forward(doc, item)
    if score <= 0:
        return 0, 0, 0
    _, back = _forward(doc[:end][::-1], item[::-1])
    return score, end - back, end


def _forward(doc: np.ndarray, item: np.ndarray) -> tuple[int, int]:
    n = len(doc)
    ramp = np.arange(n, dtype=np.int32) * -GAP
    row = np.zeros(n + 1, dtype=np.int32)
    best, end = 0, 0
    for x in item:
        step = np.where(doc == x, MATCH, MISMATCH).astype(np.int32)
        here = np.maximum(row[:-1] + step, row[1:] + GAP)
        np.maximum(here, 0, out=here)
        here = np.maximum.accumulate(here + ramp) - ramp
        row[1:] = here
        top = int(here.argmax())
        if here[top] > best:
            best, end = int(here[top]), top + 1
    return best, end


def longest_run(doc: np.ndarray, item: np.ndarray) -> int:
    """Most words of the item that doc has in a row."""
    best, row = 0, np.zeros(len(doc) + 1, dtype=np.int32)
    for x in item:
        row[1:] = np.where(doc == x, row[:-1] + 1, 0)
        best = max(best, int(row.max()))
    return best


def by_singles(words: int, min_score: float) -> bool:
    """Whether an item is so short that an alignment reaching ``min_score`` need not cover a pair."""
    return (2 * min_score - 1) * words - 1 <= 1e-9


def least_grams(words: int, min_score: float) -> int:
    """Grams of an item of so many words (pairs; single words of a short one) that any copy covers."""
    if by_singles(words, min_score):
        return max(1, math.ceil(min_score * words - 1e-9))
    need = math.ceil((2 * min_score - 1) * words - 1 - 1e-9)
    return min(need, VERBATIM_WORDS - 1) if words >= VERBATIM_WORDS else need


def reachable(doc: np.ndarray, item: np.ndarray, min_score: float) -> list[tuple[int, int]]:
    """Stretches of doc (word hashes) that hold every alignment over the threshold: around each shared gram as far as such an alignment
    can be long, which is its matches, at most the item's words, and the mismatches and gaps that its score leaves. A
    stretch without the grams that a copy must have holds none."""
    n = len(item)
    mine, theirs = (doc, item) if by_singles(n, min_score) else (Hasher.pairs(doc), Hasher.pairs(item))
    grams = GramSet(theirs)
    at = grams.places(mine)
    found = mine[at]
    reach = n + math.ceil(2 * n * (1 - min_score))
    out: list[list[int]] = []
    for p in at.tolist():
        lo, hi = max(p - reach, 0), min(p + 2 + reach, len(doc))
        if out and lo <= out[-1][1]:
            out[-1][1] = hi
        else:
            out.append([lo, hi])
    need = least_grams(n, min_score)
    most = int(grams.counts.max(initial=0))
    within = np.searchsorted(at, np.array(out, dtype=np.int64).reshape(-1, 2)).tolist()
    return [(a, b) for (a, b), (i, j) in zip(out, within) if (j - i) * most >= need and np.isin(theirs, found[i:j]).sum() >= need]


def contamination(doc: np.ndarray, item: np.ndarray, min_score: float) -> tuple[float, int, int] | None:
    """Share of the item's own score, start and end word of the best alignment, if the document is contaminated."""
    best, verbatim = (0, 0, 0), False
    for lo, hi in reachable(doc, item, min_score):
        part = doc[lo:hi]
        shared = int(np.isin(item, part).sum())
        if shared >= min_score * len(item) - 1e-9 or shared >= VERBATIM_WORDS:
            score, a, b = align(part, item)
            if score > best[0]:
                best = score, lo + a, lo + b
            if score < min_score * MATCH * len(item) and len(item) >= VERBATIM_WORDS:
                verbatim = verbatim or longest_run(part, item) >= VERBATIM_WORDS
    share = best[0] / (MATCH * len(item))
    return (share, best[1], best[2]) if share >= min_score or verbatim else None


def _item_grams(tests: DataFrame, min_score: float) -> DataFrame:
    """(item, gram, places, need): an item's distinct grams, how often each is in it, and least_grams of the item."""

    def run(batches):
        for batch in batches:
            names = batch.column("item").to_pylist()
            for lo, hi, words, begin in _hashed(batch.column("text")):
                for item, h in zip(names[lo:hi], np.split(words, begin[1:-1])):
                    if len(h) < 2:
                        continue
                    gram, places = np.unique(Hasher.singles(h) if by_singles(len(h), min_score) else Hasher.pairs(h), return_counts=True)
                    n, need = len(gram), least_grams(len(h), min_score)
                    columns = [np.full(n, item), gram, places, np.full(n, need)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["item", "gram", "places", "need"])

    return tests.select("item", "text").mapInArrow(run, "item bigint, gram bigint, places bigint, need bigint")


def _grams(words: np.ndarray, begin: np.ndarray, known: GramSet | None, singles: bool) -> tuple[np.ndarray, np.ndarray]:
    """(row, gram): distinct grams of each text of ``hash_words`` that are ``known`` (None: all), by row and gram."""
    rows, grams = [], []
    for wide, got in [(2, Hasher.pairs(words))] + [(1, Hasher.singles(words))] * singles:
        at = np.arange(len(got)) if known is None else known.places(got)
        row = np.searchsorted(begin, at, side="right") - 1
        # The last word of a text and the first of the next are no pair.
        inside = at + wide <= begin[row + 1]
        rows.append(row[inside])
        grams.append(got[at[inside]])
    row, gram = np.concatenate(rows), np.concatenate(grams)
    order = np.lexsort((gram, row))
    row, gram = row[order], gram[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (gram[1:] != gram[:-1])
    return row[new], gram[new]


def _text_grams(base: DataFrame, known: np.ndarray | None, singles: bool) -> DataFrame:
    """(digest, grams): distinct grams of (digest, text) that are ``known`` (None: all); texts without one give no row."""

    def run(batches):
        wanted = None if known is None else GramSet(known)
        for batch in batches:
            for lo, _, words, begin in _hashed(batch.column("text")):
                row, gram = _grams(words, begin, wanted, singles)
                rows, n = np.unique(row, return_counts=True)
                if len(rows):
                    ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                    arrays = pa.ListArray.from_arrays(pa.array(ends), pa.array(gram, pa.int64()))
                    yield pa.RecordBatch.from_arrays([batch.column("digest").take(pa.array(lo + rows, pa.int64())), arrays], names=["digest", "grams"])

    return base.select("digest", "text").mapInArrow(run, "digest string, grams array<bigint>")


def _seeds(grams: DataFrame, counts: DataFrame) -> DataFrame:
    """``grams`` with ``seed``: whether a gram is among the item's rarest that leave fewer than ``need`` places to the others."""
    seen = grams.join(counts, "gram", "left").withColumn("count", F.coalesce("count", F.lit(0)))
    rarest = Window.partitionBy("item").orderBy("count", "gram")
    before = F.coalesce(F.sum("places").over(rarest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("places").over(Window.partitionBy("item"))
    return seen.select("item", "gram", "places", "need", (before < total - F.col("need") + 1).alias("seed"))


def _sharing(base: DataFrame, grams: DataFrame, singles: bool) -> DataFrame:
    """(digest, item): texts of base (digest, text) that have a seed of an item and as many of its grams as a copy must have."""
    if grams.count() > BROADCAST_GRAMS:
        return _sharing_by_join(base, grams, singles)
    known = np.unique(grams.select("gram").toArrow().column("gram").to_numpy())
    if not len(known):
        return base.sparkSession.createDataFrame([], "digest string, item bigint")
    found = materialize(_text_grams(base, known, singles), "text-grams")
    counts = found.select(F.explode("grams").alias("gram")).groupBy("gram").count()
    table = _seeds(grams, counts).toArrow().sort_by("gram")
    gram, item, places, need, seed = (table.column(c).to_numpy() for c in ("gram", "item", "places", "need", "seed"))

    names, one, code = np.unique(item, return_index=True, return_inverse=True)
    need = need[one]

    def run(batches):
        for batch in batches:
            length = pc.list_value_length(batch.column("grams")).to_numpy()
            for start, stop in _blocks(length, BLOCK_GRAMS):
                got = batch.column("grams").slice(start, stop - start).flatten().to_numpy()
                begin = np.concatenate([[0], np.cumsum(length[start:stop])])
                first = np.searchsorted(gram, got)
                met = np.searchsorted(gram, got, side="right") - first
                upto = np.concatenate([[0], np.cumsum(met)])[begin]
                for lo, hi in _blocks(np.diff(upto), BLOCK_GRAMS):
                    part = slice(begin[lo], begin[hi])
                    n = met[part]
                    at = np.repeat(first[part] - np.cumsum(n) + n, n) + np.arange(n.sum())
                    pair = np.repeat(np.arange(lo, hi), np.diff(upto[lo : hi + 1])) * len(names) + code[at]
                    seeded = np.isin(pair, pair[seed[at]])
                    pairs, of = np.unique(pair[seeded], return_inverse=True)
                    rows, which = np.divmod(pairs, len(names))
                    enough = np.bincount(of, weights=places[at[seeded]], minlength=len(pairs)) >= need[which]
                    digests = batch.column("digest").take(pa.array(start + rows[enough], pa.int64()))
                    yield pa.RecordBatch.from_arrays([digests, pa.array(names[which[enough]], pa.int64())], names=["digest", "item"])

    return found.mapInArrow(run, "digest string, item bigint").distinct()


def _sharing_by_join(base: DataFrame, grams: DataFrame, singles: bool) -> DataFrame:
    """``_sharing`` where the items' grams are too many to broadcast."""
    every = _text_grams(base, None, singles).select("digest", F.explode("grams").alias("gram"))
    found = materialize(every.join(grams.select("gram").distinct(), "gram", "left_semi").distinct(), "text-grams")
    seeds = materialize(_seeds(grams, found.groupBy("gram").count()), "seeds")
    met = found.join(seeds.filter("seed").select("gram", "item"), "gram").select("digest", "item").distinct()
    shared = met.join(found, "digest").join(seeds, ["item", "gram"])
    return shared.groupBy("digest", "item").agg(F.sum("places").alias("n"), F.max("need").alias("need")).filter("n >= need").select("digest", "item")


def find_contamination(
    docs: DataFrame, items: DataFrame, min_score: float = MIN_SCORE,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
) -> DataFrame:
    """doc_id, item_id, score, start_word, end_word for each contaminated (document, item).

    ``score`` is the best alignment's share of the score that the item has with itself; the word range is where it lies. A document is
    contaminated from a score of ``min_score``, or with VERBATIM_WORDS words of the item in a row. Each
    row of docs is judged by itself, so repeated rows repeat. Null or empty texts match nothing, nor do items of a single word,
    which any text may use. Items with a null id are items like others, reported under a null id; items with equal ids
    are judged apart and reported once with the best score.

    One pass hashes the documents' word pairs and keeps those that items have; all up to the alignment works on these.
    Texts are met again by content digest, so copies of a text need one alignment per task.
    """
    text = F.col(f"`{text_col}`").cast("string")
    digest = F.sha2(F.encode(F.coalesce(text, F.lit("")), "UTF-8"), 256)
    tests = materialize(
        items.select(F.col(f"`{item_col}`").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
        .filter(F.col("text").isNotNull())
        .withColumn("item", F.monotonically_increasing_id()),
        "items",
    )
    grams = materialize(_item_grams(tests, min_score), "item-grams")
    # Single words are looked up only if there are items that need them: these have fewer grams than a pair's bound asks for.
    longest_by_singles = max(n for n in range(1, 200) if n == 1 or by_singles(n, min_score))
    singles = grams.groupBy("item").agg(F.sum("places").alias("n")).filter(F.col("n") <= longest_by_singles).limit(1).count() > 0
    base = docs.select(digest.alias("digest"), text.alias("text"))
    candidates = materialize(
        _sharing(base, grams, singles).join(tests.select("item", "item_id", F.col("text").alias("item_text")), "item"), "candidates"
    )
    texts = docs.select(
        F.struct(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.monotonically_increasing_id().alias("rid")).alias("doc"),
        digest.alias("k"),
        text.alias("text"),
    )
    # Few documents are candidates: while their keys are few enough to broadcast, only their texts are shuffled.
    keys = candidates.select(F.xxhash64("digest").alias("x")).distinct()
    if keys.count() <= BROADCAST_KEYS:
        texts = texts.join(F.broadcast(keys), F.xxhash64("k") == F.col("x"), "left_semi")
    pairs = texts.join(candidates, F.col("k") == F.col("digest")).select("doc", "digest", "text", "item_id", "item", "item_text")
    out = T.StructType(
        [
            pairs.schema["doc"],
            T.StructField("item_id", T.LongType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("start_word", T.IntegerType()),
            T.StructField("end_word", T.IntegerType()),
        ]
    )

    def run(batches):
        memo: dict[tuple, tuple[float, int, int] | None] = {}
        words: dict[int, np.ndarray] = {}
        held = 0
        for batch in batches:
            rows = []
            last_key, doc = None, None
            for k, (key, item) in enumerate(zip(batch.column("digest").to_pylist(), batch.column("item").to_pylist())):
                if (key, item) not in memo:
                    if key != last_key:
                        last_key, doc = key, hash_words(batch.column("text").slice(k, 1))[0]
                    if item not in words:
                        if held >= MEMO_WORDS:
                            words.clear()
                            held = 0
                        words[item] = hash_words(batch.column("item_text").slice(k, 1))[0]
                        held += len(words[item])
                    if len(memo) >= MEMO_WORDS:
                        memo.clear()
                    memo[key, item] = contamination(doc, words[item], min_score)
                rows.append(memo[key, item])
            hit = [i for i, r in enumerate(rows) if r is not None]
            take = pa.array(hit, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc").take(take),
                    batch.column("item_id").take(take),
                    pa.array([rows[i][0] for i in hit], pa.float64()),
                    pa.array([rows[i][1] for i in hit], pa.int32()),
                    pa.array([rows[i][2] for i in hit], pa.int32()),
                ],
                names=[f.name for f in out.fields],
            )

    found = pairs.mapInArrow(run, out)
    best = found.groupBy("doc", "item_id").agg(
        F.max(F.struct("score", (-F.col("start_word")).alias("s"), (-F.col("end_word")).alias("e"))).alias("b")
    )
    return best.select(
        F.col("doc.doc_id").alias("doc_id"),
        "item_id",
        F.col("b.score").alias("score"),
        (-F.col("b.s")).alias("start_word"),
        (-F.col("b.e")).alias("end_word"),
    )


def clean_documents(docs: DataFrame, items: DataFrame, min_score: float = MIN_SCORE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without a copy of any item; all columns unchanged."""
    cols = docs.columns
    stored = store_texts(
        docs.select(F.monotonically_increasing_id().alias("row_number"), F.struct(*(F.col(f"`{c}`") for c in cols)).alias("row")),
        "numbered",
    )
    texts = stored.select("row_number", F.col(f"row.`{text_col}`").cast("string").alias("text"))
    hits = find_contamination(texts, items, min_score, id_col="row_number")
    return stored.join(hits.select(F.col("doc_id").alias("row_number")).distinct(), "row_number", "left_anti").select(
        *(F.col(f"row.`{c}`").alias(c) for c in cols)
    )
