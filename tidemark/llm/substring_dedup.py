"""Substring dedup by line hashing.

Texts are cut into units and the units hashed: equal digests are grouped over all documents, the earliest
occurrence stays, and later ones are removed, with their offsets in the original text. Words are compared with A-Z as a-z and any
white space between them. There are two kinds of units:

* every line of at least MIN_LINE_WORDS words: a later occurrence goes as a whole;
* windows of WINDOW_WORDS words, for passages that lie anywhere in a line or across lines. Of every PICK neighbouring windows the one
  with the smallest digest is a unit (PICK = MIN_RUN_WORDS - WINDOW_WORDS + 1), so two texts that share MIN_RUN_WORDS words share a window, wherever these words lie.
  A run of later windows is extended word by word, PICK - 1 words to either side, while its end agrees with the earliest occurrence
  of its outermost window. What such passages cover goes where it is at least MIN_RUN_WORDS words long.

Later windows that touch, or that follow each other in the earliest occurrence as well with the same words between, are one
run, so only runs' ends are compared word by word, and only a few words around them leave the texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import discard, ship, store_at, store_texts
from tidemark.session import materialize, scratch_path

ship(__name__)

# The shortest passage that is removed, in words, and the shortest line.
MIN_RUN_WORDS = 20
MIN_LINE_WORDS = 5
WINDOW_WORDS = 8
MEMO_WORDS = 500_000
# A digest with this share of all units counts as hot; at most 1 / share digests can be.
HOT_SHARE = 1e-3
# Keys of texts to look into are broadcast up to this many (8 bytes each); beyond it all texts are shuffled.
BROADCAST_KEYS = 1_000_000

_WHITE = np.zeros(33, dtype=bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_MULTIPLIER = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_LINE = np.uint64(0xD6E8FEB86659FD93)


class Words:
    """The words of texts: 64-bit hashes and where each starts and stops (code points, stop exclusive)."""

    def __init__(self):
        self.memo: dict[bytes, int] = {}

    @staticmethod
    def split(text: str | None) -> list[bytes]:
        return (text or "").encode("utf-8", "surrogatepass").lower().split()

    def hashes(self, words: list[bytes]) -> np.ndarray:
        memo = self.memo
        if len(memo) >= MEMO_WORDS:
            memo.clear()
        got = list(map(memo.get, words))
        if None in got:
            for i, w in enumerate(words):
                if got[i] is None:
                    got[i] = memo[w] = xxhash.xxh64_intdigest(w)
        return np.array(got, dtype=np.uint64)

    @staticmethod
    def places(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and stops of the words, and the code points."""
        points = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        white = (points <= 32) & _WHITE[np.minimum(points, 32)]
        edges = np.diff(np.concatenate([[True], white, [True]]).astype(np.int8))
        return np.flatnonzero(edges == -1), np.flatnonzero(edges == 1), points


def _smallest(values: np.ndarray, among: int) -> np.ndarray:
    """Places of the smallest value (the first of equal ones) of every ``among`` neighbours; of all, if there are fewer."""
    m = len(values)
    if m <= among:
        return np.array([int(values.argmin())] if m else [], dtype=np.int64)
    n = m - among + 1
    best, at = values[:n].copy(), np.zeros(n, dtype=np.int64)
    for j in range(1, among):
        here = values[j : j + n]
        less = here < best
        best[less], at[less] = here[less], j
    return np.unique(at + np.arange(n))


class UnitCutter:
    """Units of a text: first word, number of words, digest, digest of the words since the unit before (windows only), whether a line."""

    def __init__(self, min_run_words: int = MIN_RUN_WORDS, min_line_words: int = MIN_LINE_WORDS):
        self.pick, self.min_line_words = min_run_words - WINDOW_WORDS + 1, min_line_words
        self.words = Words()
        self.power = self.back = np.empty(0, dtype=np.uint64)

    def __call__(self, text: str | None):
        h = self.words.hashes(self.words.split(text))
        n = len(h)
        if not n:
            none = np.empty(0, dtype=np.int64)
            return none, none, none, none, none.astype(bool)
        if len(self.power) < n:
            self.power = np.full(2 * n, _MULTIPLIER, dtype=np.uint64).cumprod()
            self.back = np.full(2 * n, _INVERSE, dtype=np.uint64).cumprod()
        power, back = self.power[:n], self.back[:n]
        sums = np.concatenate([[np.uint64(0)], (h * power).cumsum()])

        def digest(a, b):
            d = (sums[b] - sums[a]) * back[a] + (b - a).astype(np.uint64) * _LINE
            d ^= d >> np.uint64(32)
            d *= np.uint64(_MULTIPLIER)
            return d ^ d >> np.uint64(29)

        a = np.arange(max(n - WINDOW_WORDS + 1, 0))
        windows = digest(a, a + WINDOW_WORDS)
        pos = _smallest(windows, self.pick)
        gap = np.zeros(len(pos), dtype=np.uint64)
        gap[1:] = digest(pos[:-1], pos[1:])
        # lines
        starts, ends, points = self.words.places(text)
        breaks = np.concatenate([[0], np.cumsum(points == 10)])
        stop = np.concatenate([np.flatnonzero(breaks[starts[1:]] != breaks[ends[:-1]]) + 1, [n]])
        first = np.concatenate([[0], stop[:-1]])
        long = stop - first >= self.min_line_words
        first, stop = first[long], stop[long]
        return (
            np.concatenate([pos, first]),
            np.concatenate([np.full(len(pos), WINDOW_WORDS), stop - first]),
            np.concatenate([windows[pos], digest(first, stop) ^ _LINE]).view(np.int64),
            np.concatenate([gap, np.zeros(len(first), dtype=np.uint64)]).view(np.int64),
            np.concatenate([np.zeros(len(pos), dtype=bool), np.ones(len(first), dtype=bool)]),
        )


def cut_units(docs: DataFrame, min_run_words: int = MIN_RUN_WORDS, min_line_words: int = MIN_LINE_WORDS) -> DataFrame:
    """(rid, doc_id, pos, words, line, digest, gap) per unit of docs (rid, doc_id, text)."""

    def run(batches):
        cutter = UnitCutter(min_run_words, min_line_words)
        for batch in batches:
            got = [cutter(t.as_py()) for t in batch.column("text")]
            for a in range(0, len(got), 512):  # bounded output batches
                part = got[a : a + 512]
                take = pa.array(np.repeat(np.arange(a, a + len(part)), [len(g[0]) for g in part]))
                pos, words, digest, gap, line = (np.concatenate([g[i] for g in part]) for i in range(5))
                columns = [pos.astype(np.int32), words.astype(np.int32), line, digest, (gap & 0x7FFFFFFF).astype(np.int32)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("rid").take(take), batch.column("doc_id").take(take), *map(pa.array, columns)],
                    names=["rid", "doc_id", "pos", "words", "line", "digest", "gap"],
                )

    return docs.select("rid", "doc_id", "text").mapInArrow(
        run, "rid bigint, doc_id bigint, pos int, words int, line boolean, digest bigint, gap int"
    )


def _later(units: DataFrame) -> DataFrame:
    """Units whose digest occurs earlier, with the earliest occurrence's k_rid, k_doc, k_pos, k_gap.

    Digests with more than HOT_SHARE of all units are found by counting; their earliest occurrences come from a grouping that
    reduces on the map side and are broadcast back. All units share one shuffle, whose sorted groups are read as a stream; no
    hot group is met in it.
    """
    bound = max(1, int(units.count() * HOT_SHARE))
    counted = units.groupBy("digest").count().filter(F.col("count") > bound)
    hot = [r["digest"] for r in counted.select("digest").collect()]  # at most 1 / HOT_SHARE
    rank = [F.col("doc_id").isNull(), F.col("doc_id"), F.col("rid"), F.col("pos")]
    place = F.struct(rank[0].alias("unnamed"), "doc_id", "rid", "pos", "gap")
    hot_first = materialize(units.filter(F.col("digest").isin(hot)).groupBy("digest").agg(F.min(place).alias("hot_first")), "hot-first")
    # The left join keeps one row per unit. In the shuffle each hot unit is a group of its own.
    marked = units.join(F.broadcast(hot_first), "digest", "left")
    alone = F.when(F.col("hot_first").isNotNull(), F.xxhash64("rid", "pos")).otherwise(0)
    in_order = Window.partitionBy("digest", "alone").orderBy(*rank)
    both = marked.withColumn("alone", alone).withColumn("first", F.coalesce("hot_first", F.first(place).over(in_order)))
    # Not the first itself, and none that overlaps its own first occurrence.
    later = both.filter((F.col("rid") != F.col("first.rid")) | (F.col("pos") >= F.col("first.pos") + F.col("words")))
    return later.select(
        "rid", "doc_id", "pos", "words", "line", "gap",
        F.col("first.rid").alias("k_rid"), F.col("first.doc_id").alias("k_doc"), F.col("first.pos").alias("k_pos"), F.col("first.gap").alias("k_gap"),
    )


def _runs(later: DataFrame) -> DataFrame:
    """(rid, doc_id, run, line, first, until, k_doc, left, right): later windows that touch or are chained, and lines by themselves.

    ``left`` and ``right`` are where the outermost windows' earliest occurrences begin and end: (k_rid, k_p). Windows are chained that
    follow each other in the earliest occurrence as well, with the same words between.
    """
    per_doc = Window.partitionBy("rid").orderBy("line", "pos")
    before = lambda c: F.lag(c).over(per_doc)
    touching = F.col("pos") <= before("pos") + before("words")
    chained = (
        (before("k_rid") == F.col("k_rid"))
        & (F.col("pos") - before("pos") == F.col("k_pos") - before("k_pos"))
        & (F.col("gap") == F.col("k_gap"))
        & (F.col("gap") != 0)
    )
    joined = ~F.col("line") & (touching | chained)
    numbered_ = later.withColumn("new", (~F.coalesce(joined, F.lit(False))).cast("int")).withColumn("run", F.sum("new").over(per_doc))
    return numbered_.groupBy("rid", "doc_id", "run").agg(
        F.max("line").alias("line"),
        F.min("pos").alias("first"),
        F.max(F.col("pos") + F.col("words")).alias("until"),
        F.min_by("k_doc", "pos").alias("k_doc"),
        F.min_by(F.struct("k_rid", F.col("k_pos").alias("k_p")), "pos").alias("left"),
        F.max_by(F.struct("k_rid", (F.col("k_pos") + F.col("words")).alias("k_p")), "pos").alias("right"),
    )


def _sides(texts: DataFrame, reach: int) -> DataFrame:
    """(rid, right, p, h, offs, base) for texts (rid, text, ps: the asked (right, p)).

    Left of word p, or from word p on: hashes of up to ``reach`` words going outwards, the offsets at which each begins (or ends), and the
    offset of the edge itself.
    """

    def run(batches):
        words = Words()
        for batch in batches:
            out = [[], [], [], [], [], []]
            for rid, t, ps in zip(batch.column("rid").to_pylist(), batch.column("text"), batch.column("ps").to_pylist()):
                text = t.as_py()
                split = words.split(text)
                starts, stops, _ = words.places(text)
                for ask in ps:
                    right, p = ask["right"], ask["p"]
                    lo = max(p - reach, 0)
                    near = split[p : p + reach] if right else split[lo:p][::-1]
                    h = words.hashes(near).view(np.int64)
                    values = (rid, True, p, h, stops[p : p + reach], stops[p - 1]) if right else (rid, False, p, h, starts[lo:p][::-1], starts[p])
                    for column, v in zip(out, values):
                        column.append(v)
            kinds = [pa.int64(), pa.bool_(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["rid", "right", "p", "h", "offs", "base"])

    return texts.select("rid", "text", "ps").mapInArrow(run, "rid bigint, right boolean, p int, h array<bigint>, offs array<int>, base int")


def _extended(docs: DataFrame, runs: DataFrame, reach: int) -> DataFrame:
    """``runs`` with first and until moved outwards while the words agree, and their offsets start and stop."""
    ends = F.array(
        F.struct(F.lit(False).alias("right"), F.col("first").alias("p"), "left.k_rid", "left.k_p"),
        F.struct(F.lit(True).alias("right"), F.col("until").alias("p"), "right.k_rid", "right.k_p"),
    )
    edges = runs.select("rid", "run", "line", F.explode(ends).alias("e")).select("rid", "run", "line", "e.*")
    # A line is whole, and before the first word there is nothing to compare.
    compared = ~F.col("line") & (F.col("right") | (F.least("p", "k_p") > 0))
    asked = edges.select("rid", "right", "p").unionByName(edges.filter(compared).select(F.col("k_rid").alias("rid"), "right", F.col("k_p").alias("p"))).distinct()
    asked = materialize(asked.groupBy("rid").agg(F.collect_list(F.struct("right", "p")).alias("ps")), "asked")
    texts = docs.select("rid", "text")
    if asked.count() <= BROADCAST_KEYS:
        texts = texts.join(F.broadcast(asked.select("rid")), "rid", "left_semi")
    sides = materialize(_sides(texts.join(asked, "rid"), reach), "sides")
    own = edges.join(sides, ["rid", "right", "p"])
    kept = sides.select(F.col("rid").alias("k_rid"), "right", F.col("p").alias("k_p"), F.col("h").alias("k_h"))
    agree = F.zip_with("h", "k_h", lambda a, b: F.coalesce(a == b, F.lit(False)))
    differs = F.array_position(agree, F.lit(False))
    n = F.when(F.col("k_h").isNull(), 0).when(differs == 0, F.size(agree)).otherwise(differs - 1)
    # Within one text a passage does not reach back into its own earliest occurrence.
    clear = F.when(~F.col("right") & (F.col("rid") == F.col("k_rid")), F.greatest(F.col("p") - F.col("k_p") - WINDOW_WORDS, F.lit(0))).otherwise(reach)
    # Lines ask for no comparison, so they meet no kept side.
    asks = F.when(compared, F.col("k_rid"))
    joined = own.withColumn("a", asks).alias("o").join(
        kept.alias("k"),
        (F.col("o.a") == F.col("k.k_rid")) & (F.col("o.right") == F.col("k.right")) & (F.col("o.k_p") == F.col("k.k_p")),
        "left",
    ).select("o.*", "k.k_h")
    found = joined.withColumn("n", F.least(n, clear).cast("int")).select(
        "rid", "run", "right", "p", "n", F.when(F.col("n") == 0, F.col("base")).otherwise(F.get("offs", F.col("n") - 1)).alias("at")
    )
    left, right = ~F.col("right"), F.col("right")
    moved = found.groupBy("rid", "run").agg(
        F.max(F.when(left, F.col("p") - F.col("n"))).alias("first"),
        F.max(F.when(left, F.col("at"))).alias("start"),
        F.max(F.when(right, F.col("p") + F.col("n"))).alias("until"),
        F.max(F.when(right, F.col("at"))).alias("stop"),
    )
    return runs.select("rid", "run", "doc_id", "line", "k_doc").join(moved, ["rid", "run"])


def _passages(pieces: DataFrame, min_run_words: int) -> DataFrame:
    """Pieces that overlap or touch are one passage; shorter ones than ``min_run_words`` leave only their whole lines."""
    per_doc = Window.partitionBy("rid").orderBy("first", "until", "run")
    apart = F.coalesce(F.max("until").over(per_doc.rowsBetween(Window.unboundedPreceding, -1)) < F.col("first"), F.lit(True))
    grouped = pieces.withColumn("apart", apart.cast("int")).withColumn("group", F.sum("apart").over(per_doc))
    per_group = Window.partitionBy("rid", "group")
    long = F.max("until").over(per_group) - F.min("first").over(per_group) >= min_run_words
    grouped = grouped.withColumn("long", long).filter("long or line")
    return (
        grouped.groupBy("rid", "doc_id", "group", F.when(~F.col("long"), F.col("first")).alias("alone"))
        .agg(
            F.min("start").alias("start"),
            F.max("stop").alias("stop"),
            (F.max("until") - F.min("first")).alias("words"),
            F.min_by("k_doc", F.struct("first", "until", "run")).alias("kept_doc_id"),
        )
        .drop("group", "alone")
    )


def repeated_passages(docs: DataFrame, min_run_words: int = MIN_RUN_WORDS, min_line_words: int = MIN_LINE_WORDS) -> DataFrame:
    """(rid, doc_id, start, stop, words, kept_doc_id): passages to remove from docs (rid, doc_id, text).

    The rank of an occurrence is (doc_id, rid, place in the text), null ids last. ``kept_doc_id`` is the document of the earliest
    occurrence of the passage's first piece. A passage's ends are found up to PICK - 1 words beyond its outermost windows, which is as far
    as it can reach while these have their earliest occurrence in one text; where they have it in another, shorter one,
    fewer words at that end are found.
    """
    spark = docs.sparkSession
    reach = min_run_words - WINDOW_WORDS
    path = scratch_path(spark, "units")
    units = store_at(cut_units(docs, min_run_words, min_line_words), path)
    later = store_texts(_later(units), "later-units")
    discard(spark, path)
    runs = materialize(_runs(later), "runs")
    return _passages(materialize(_extended(docs, runs, reach), "pieces"), min_run_words)


def numbered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cols: list[str] | None = None) -> DataFrame:
    """docs as a stored table (rid, doc_id, text, row with the columns ``cols``): the row's number is fixed by writing it."""
    extra = [F.struct(*(F.col(f"`{c}`") for c in cols)).alias("row")] if cols else []
    return store_texts(
        docs.select(
            F.monotonically_increasing_id().alias("rid"),
            F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
            F.col(f"`{text_col}`").cast("string").alias("text"),
            *extra,
        ),
        "numbered",
    )


def duplicate_passages(docs: DataFrame, min_run_words: int = MIN_RUN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, start, stop, words, kept_doc_id: every passage or line that repeats an earlier one.

    Offsets count code points of the original text, stop exclusive. Documents without such a
    passage, null and empty texts give no row; of rows that repeat as a whole all but the first do.
    """
    found = repeated_passages(numbered(docs, id_col, text_col), min_run_words)
    return found.select("doc_id", "start", "stop", F.col("words").cast("bigint").alias("words"), "kept_doc_id")


def remove_passages(docs: DataFrame, min_run_words: int = MIN_RUN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated passages cut out of the text.

    Every row stays, with an empty text if all of it repeats; n_chars, where there is one, follows
    the text. White space after a removed passage goes with it up to the line's end.
    """
    base = numbered(docs, id_col, text_col, [c for c in docs.columns if c != text_col])
    found = repeated_passages(base.select("rid", "doc_id", "text"), min_run_words)
    spans = found.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans"))
    joined = base.join(spans, "rid", "left")
    n = F.size("spans")
    pieces = F.transform(
        F.sequence(F.lit(0), n),
        lambda i: F.substring(
            F.col("text"),
            F.coalesce(F.get("spans", i - 1)["stop"], F.lit(0)) + 1,
            F.coalesce(F.get("spans", i)["start"], F.char_length("text")) - F.coalesce(F.get("spans", i - 1)["stop"], F.lit(0)),
        ),
    )
    trimmed = F.transform(pieces, lambda p, i: F.when(i == 0, p).otherwise(F.regexp_replace(p, r"^[ \t]+", "")))
    text = F.when(F.col("spans").isNull(), F.col("text")).otherwise(F.array_join(trimmed, ""))
    out = joined.select("row", F.col("text"), text.alias("cut"))
    done = {c: F.col(f"row.`{c}`") for c in docs.columns if c != text_col}
    done[text_col] = F.col("cut").cast(docs.schema[text_col].dataType)
    if "n_chars" in done:
        counted = F.char_length("cut").cast(docs.schema["n_chars"].dataType)
        done["n_chars"] = F.when(F.col("text").eqNullSafe(F.col("cut")), done["n_chars"]).otherwise(counted)
    return out.select(*(done[c].alias(c) for c in docs.columns))
