"""Token counts through a digest cache.

A text is known by the SHA-256 of its normalised content, a tokenizer by the SHA-256 of its file, its
library and the library's release. The cache is a folder of (digest, n_tokens) tables, one sub-folder
per tokenizer version and one below it per appended batch. Documents meet stored counts by digest; each
distinct content without a count is encoded once, and its count is appended.

Every row of the cache is right by itself. So a batch that a crash cut short does no harm, writers need
no lock, and rows that two of them append twice are merged when read.

Normalised content is the text (null: empty); where the tokenizer itself makes one space of every run of
white space, so does the digest, and such texts share a count. Nothing else is normalised, as it could change counts.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE_RUN, ship
from tidemark.session import materialize, path_exists

ship(__name__)

# Texts are encoded in groups of about so many characters, and longer ones in parts where a cut is exact.
GROUP_CHARS = 1_000_000
# While so few contents miss the cache, and less than half of all, their 8-byte keys are broadcast to leave other texts out of the shuffle.
BROADCAST_KEYS = 1_000_000
# The byte-level pattern takes white space into a word at its front only, so before a run of white space a word always ends
# and the runs' counts add up. White space other than these four may lie within a longer run of its own: such texts stay whole.
CHUNKS = re.compile(r"[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+")
OTHER_SPACE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
SAFE_CUT = re.compile(r"[A-Za-z](?=[ \n])")
# Counts of words that a task keeps; beyond it the memory starts anew.
MEMO_WORDS = 400_000


class Tokenizer:
    """A tokenizer file's bytes and what follows from them; picklable, loaded once per task."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.data = f.read()
        self.kind = "tokenizers" if path.endswith(".json") else "sentencepiece"
        if self.kind == "tokenizers":
            import tokenizers

            release, spec = tokenizers.__version__, json.loads(self.data)
        else:
            import sentencepiece

            release, spec = sentencepiece.__version__, {}
        head = f"{self.kind} {release} ".encode()
        self.version = hashlib.sha256(head + hashlib.sha256(self.data).digest()).hexdigest()
        added = spec.get("added_tokens") or []
        plain = not any(re.search(r"\s", a["content"]) or a.get("lstrip") or a.get("rstrip") for a in added)
        norm, pre = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
        steps = norm.get("normalizers", [norm])
        self.one_space = plain and {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "} in steps
        self.cuttable = plain and not norm and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")

    def normal(self, text: Column) -> Column:
        """Content under which equal texts have equal counts."""
        text = F.coalesce(text.cast("string"), F.lit(""))
        return F.regexp_replace(text, SPACE_RUN, " ") if self.one_space else text

    def load(self):
        """A function from a list of texts to their numbers of tokens."""
        if self.kind == "sentencepiece":
            from sentencepiece import SentencePieceProcessor

            sp = SentencePieceProcessor(model_proto=self.data)
            return lambda texts: [len(ids) for ids in sp.encode(texts, num_threads=1)]
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer as Library

        lib = Library.from_str(self.data.decode("utf-8"))
        lib.no_truncation()
        lib.no_padding()
        encode = lambda texts: [len(e) for e in lib.encode_batch_fast(texts, add_special_tokens=False)]
        return self._by_words(encode) if self.cuttable else encode

    @staticmethod
    def _by_words(encode):
        """``encode`` for texts, but asked once for every distinct word with the white space before it."""
        memo: dict[str, int] = {}

        def run(texts: list[str]) -> list[int]:
            whole = [OTHER_SPACE.search(t) is not None for t in texts]
            words = [[t] if w else CHUNKS.findall(t) for t, w in zip(texts, whole)]
            if len(memo) > MEMO_WORDS:
                memo.clear()
            new = list(set().union(*words) - memo.keys())
            memo.update(zip(new, encode(new)))
            out = [sum(map(memo.__getitem__, ws)) for ws in words]
            for w in new:
                if len(w) > 100:  # whole texts and the like are not kept
                    del memo[w]
            return out

        return run

    def parts(self, text: str, size: int = GROUP_CHARS) -> list[str]:
        """The text in parts of about ``size`` characters whose counts add up to the whole's; whole where no cut is exact."""
        out, at = [], 0
        while self.cuttable and len(text) - at > size:
            m = SAFE_CUT.search(text, at + size)
            if m is None:
                break
            out.append(text[at : m.end()])
            at = m.end()
        out.append(text[at:] if at else text)
        return out


def count_texts(contents: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """(digest, n_tokens) of (digest, text), by the tokenizer's own library."""

    def run(batches):
        count = tokenizer.load()
        for batch in batches:
            totals = [0] * batch.num_rows
            group, owner, chars = [], [], 0

            def flush():
                for k, n in zip(owner, count(group)):
                    totals[k] += n
                group.clear()
                owner.clear()

            for k, t in enumerate(batch.column("text")):
                for part in tokenizer.parts(t.as_py()):
                    group.append(part)
                    owner.append(k)
                    chars += len(part)
                    if chars >= GROUP_CHARS:
                        flush()
                        chars = 0
            flush()
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(totals, pa.int64())], names=["digest", "n_tokens"])

    return contents.select("digest", "text").mapInArrow(run, "digest binary, n_tokens bigint")


def _folder(cache: str, tokenizer: Tokenizer) -> str:
    return f"{cache.rstrip('/')}/tokenizer={tokenizer.version}"


def cached_counts(spark: SparkSession, cache: str, tokenizer: Tokenizer) -> DataFrame:
    """(digest, n_tokens) that the cache holds for this version of the tokenizer, one row per digest."""
    folder = _folder(cache, tokenizer)
    if not path_exists(spark, folder):
        return spark.createDataFrame([], "digest binary, n_tokens bigint")
    stored = spark.read.schema("digest binary, n_tokens bigint").option("recursiveFileLookup", True).parquet(folder)
    return stored.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def append_counts(counts: DataFrame, cache: str, tokenizer: Tokenizer) -> None:
    """Add a batch of (digest, n_tokens) in a folder of its own."""
    counts.select("digest", "n_tokens").write.parquet(f"{_folder(cache, tokenizer)}/batch={uuid.uuid4().hex}")


def count_tokens(docs: DataFrame, tokenizer: Tokenizer, cache: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens of every row of ``docs``; the cache folder gains the contents it lacked.

    A null text counts as empty. Repeated rows and null ids give a row each; other columns, whatever their
    names, are not read. An empty table gives no rows and leaves the cache as it is.

    Only digests are shuffled to find the misses, and only the misses' texts to encode them: copies within
    a task are reduced before that shuffle, so a text that a third of all rows hold is encoded once and its copies spread.
    """
    spark = docs.sparkSession
    text = F.col(f"`{text_col}`").cast("string")
    digest = F.unhex(F.sha2(F.encode(tokenizer.normal(text), "UTF-8"), 256)).alias("digest")
    rows = materialize(
        docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("n_bytes"), digest),
        "token-count-rows",
    )
    wanted = materialize(rows.select("digest").distinct(), "token-count-wanted")
    known = cached_counts(spark, cache, tokenizer)
    missing = materialize(wanted.join(known, "digest", "left_anti"), "token-count-missing")
    n_missing = missing.count()
    if n_missing:
        texts = docs.select(digest, F.coalesce(text, F.lit("")).alias("text"))
        if n_missing <= BROADCAST_KEYS and 2 * n_missing < wanted.count():
            keys = missing.select(F.xxhash64("digest").alias("key"))
            texts = texts.join(F.broadcast(keys), F.xxhash64("digest") == F.col("key"), "left_semi")
        once = texts.groupBy("digest").agg(F.first("text").alias("text")).join(missing, "digest", "left_semi")
        append_counts(count_texts(once, tokenizer), cache, tokenizer)
    # One stored row per digest, so the join below is plain and a hot digest's rows can be split.
    counts = materialize(cached_counts(spark, cache, tokenizer).join(wanted, "digest", "left_semi"), "token-counts")
    return rows.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens")
