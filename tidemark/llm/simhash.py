"""SimHash near-duplicates by deletion-variant signatures.

A 64-bit fingerprint is cut into so few segments that, within the allowed distance, one
segment differs by at most one bit. Each segment is indexed once per wildcard bit; equal
signatures are joined, and each pair is verified. Linked fingerprints form components.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import ship, store_texts
from tidemark.session import materialize

ship(__name__)

BITS = 64
SEED = 42


def fingerprint(text: str | None, shingle_words: int) -> int:
    """Unsigned fingerprint of a whole text: majority bits over the XXH64 of its word shingles."""
    ws = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, ASCII white space
    if not ws:
        return 0
    if len(ws) < shingle_words:
        hashes = [xxhash.xxh64_intdigest(b" ".join(ws), SEED)]
    else:
        joined = b" ".join(ws)
        ends = np.cumsum([len(w) + 1 for w in ws])
        starts = (ends - [len(w) + 1 for w in ws]).tolist()
        stops = (ends - 1).tolist()[shingle_words - 1 :]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, stops)]
    h = np.array(hashes, dtype=np.uint64)
    ones = np.zeros(BITS, dtype=np.int64)
    for block in range(0, len(h), 1 << 16):
        part = h[block : block + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(h)).tobytes(), "big")


def add_fingerprints(docs: DataFrame, text_col: str = "text", shingle_words: int = 4, out_col: str = "fp", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all but a clashing one) and the fingerprint as a signed long.

    Words are runs without ASCII white space, A-Z count as a-z, shingles repeat as often as
    they occur; a text with fewer words than a shingle is one shingle, one without words (or null) has
    fingerprint zero. One pass of Arrow batches; no shuffle.
    """
    names = keep if keep is not None else [c for c in docs.columns if c.lower() != out_col.lower()]
    fields = [docs.schema[c] for c in names]
    base = docs.select(*(F.col(f"`{c}`") for c in names), F.col(f"`{text_col}`").cast("string").alias("__text"))
    out = T.StructType(fields + [T.StructField(out_col, T.LongType())])

    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle_words) for t in batch.column("__text")], dtype=np.uint64)
            cols = [batch.column(i) for i in range(batch.num_columns - 1)] + [pa.array(fps.view(np.int64))]
            yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in out.fields])

    return base.mapInArrow(run, out)


def _segments(max_bits: int) -> list[tuple[int, int]]:
    """(low bit, width) of the fewest segments of which one differs by at most one bit."""
    n = max(2, max_bits // 2 + 1)  # with n segments of two differing bits or more there would be 2n > max_bits
    cuts = [BITS * k // n for k in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _segment_value(fp: Column, low: int, width: int) -> Column:
    mask = (1 << width) - 1
    value = F.shiftrightunsigned(fp, low) if low else fp
    return value if width == BITS else value.bitwiseAND(F.lit(mask))


def signatures(fps: DataFrame, max_bits: int) -> DataFrame:
    """One row per fingerprint and wildcard bit: (fp, bit, rest), rest being the segment without that bit."""
    parts = [
        F.struct(
            F.lit(low + i).alias("bit"),
            _segment_value(F.col("fp"), low, width).bitwiseAND(F.lit(~(1 << i))).alias("rest"),
        )
        for low, width in _segments(max_bits)
        for i in range(width)
    ]
    return fps.select("fp", F.explode(F.array(*parts)).alias("s")).select("fp", "s.bit", "s.rest")


def _first_shared_bit(a: Column, b: Column, max_bits: int) -> Column:
    """The lowest wildcard bit at which two fingerprints share a signature, so each pair is kept once."""
    out = None
    x = a.bitwiseXOR(b)
    for low, width in _segments(max_bits):
        part = _segment_value(x, low, width)
        # One differing bit at place i shares wildcard i alone; none shares all, the lowest first.
        at = F.when(part == 0, F.lit(low)).otherwise(F.lit(low) + F.bit_count(part - 1))
        close = F.bit_count(part) <= 1
        out = F.when(close, at) if out is None else out.when(close, at)
    return out


def fingerprint_links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Pairs (a, b), a < b, of the distinct fingerprints ``fps`` at ``max_bits`` or fewer differing bits."""
    sigs = signatures(fps, max_bits)
    left = sigs.select(F.col("fp").alias("a"), "bit", "rest")
    right = sigs.select(F.col("fp").alias("b"), F.col("bit").alias("bit2"), F.col("rest").alias("rest2"))
    near = (
        (F.col("bit") == F.col("bit2"))
        & (F.col("rest") == F.col("rest2"))
        & (F.col("a") < F.col("b"))
        & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
        & (_first_shared_bit(F.col("a"), F.col("b"), max_bits) == F.col("bit"))
    )
    # Never broadcast: the planner's size estimate does not see the signatures multiply.
    return left.join(right.hint("merge"), near).select("a", "b")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node reachable, for every node of ``edges`` (a, b).

    Alternating large-star and small-star steps (Kiveris et al., 2014), each written to
    the checkpoint folder; minima are taken by partial aggregation before the shuffle.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            both = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        low = materialize(low, "star-minima")
        joined = both.join(low, F.col("a") == F.col("n"))
        if large:
            new = joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            new = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select(F.col("n").alias("a"), F.col("m").alias("b")))
        return new.filter(F.col("a") != F.col("b")).distinct()

    def mark(e: DataFrame):
        return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    edges = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    seen = mark(edges)
    while seen[0]:
        edges = materialize(star(star(edges, True), False), "edges")
        now = mark(edges)
        if now == seen:
            break
        seen = now
    # At the fixed point every edge leads from a node to its component's least node.
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def component_table(prints: DataFrame, max_bits: int, id_col: str = "doc_id") -> DataFrame:
    """(fp, root, component_id) per fingerprint: the least fingerprint linked with it, directly
    or not, and the smallest id among the rows of all these."""
    groups = materialize(prints.groupBy("fp").agg(F.min(f"`{id_col}`").alias("least")), "fingerprints")
    roots = connected_components(fingerprint_links(groups.select("fp"), max_bits))
    rooted = groups.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    lows = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return materialize(rooted.join(lows, "root").select("fp", "root", "component_id"), "components")


def near_duplicates(docs: DataFrame, shingle_words: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row of ``docs``.

    Component ids ignore null ids and are null where a component has no other; rows repeat as in the
    input. Only (id, fingerprint) rows are shuffled; equal fingerprints are one node, so copies make no pairs.
    """
    prints = materialize(
        add_fingerprints(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")), "text", shingle_words, keep=["doc_id"]),
        "prints",
    )
    comps = component_table(prints, max_bits).withColumnRenamed("fp", "k")
    return prints.join(comps, F.col("fp") == F.col("k")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_first(docs: DataFrame, shingle_words: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` of which no near-duplicate comes earlier: one row of each component.

    The order is the id (nulls last) and then the row's place, so of rows that share the
    smallest id one stays. All columns return unchanged.
    """
    cols = docs.columns
    numbered = docs.select(F.struct(*(F.col(f"`{c}`") for c in cols)).alias("row"), F.monotonically_increasing_id().alias("rid"))
    numbered = numbered.select("row", "rid", F.col(f"row.`{id_col}`").alias("id"), F.col(f"row.`{text_col}`").alias("text"))
    stored = store_texts(add_fingerprints(numbered, "text", shingle_words, keep=["row", "rid", "id"]), "prints")
    comps = component_table(stored.select(F.col("id").alias("doc_id"), "fp"), max_bits, "doc_id")
    place = F.struct(F.col("id").isNull().alias("unnamed"), F.col("id"), F.col("rid"))
    first = (
        stored.groupBy("fp")
        .agg(F.min(place).alias("p"))
        .join(comps, "fp")
        .groupBy("root")
        .agg(F.min("p").alias("p"))
        .select(F.col("p.rid").alias("rid"))
    )
    return stored.join(first, "rid", "left_semi").select(*(F.col(f"row.`{c}`").alias(c) for c in cols))
