"""Sharding, quality rules, chat formatting and URL filters against brute force."""

from __future__ import annotations

import datetime as dt
import hashlib
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import chat, quality_rules, sharding, url_filter
from tidemark.llm.queries import QUERIES

M = 1 << 64
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def jump(key, n):
    key, b, j = key % M, -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % M
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_shard_matches_loop_and_moves_only_into_new_shard(spark):
    keys = [0, 1, -1, 2**63 - 1, -(2**63), *range(5, 400)]
    now, grown = sharding.jump_shard(F.col("k"), 24)
    rows = spark.createDataFrame([(k,) for k in keys], "k bigint").select("k", now.alias("a"), grown.alias("b")).collect()
    for r in rows:
        assert (r.a, r.b) == (jump(r.k, 24), jump(r.k, 25))
        assert r.b in (r.a, 24)


def test_shard_documents_slots_and_edges(spark, odd_docs, empty_docs):
    rows = sharding.shard_documents(odd_docs, 3).collect()
    assert len(rows) == odd_docs.count()
    for s in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    texts = {(r.doc_id, r.text) for r in odd_docs.collect()}
    expect = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in ((r.doc_id, r.text) for r in odd_docs.collect()))
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == expect and texts
    assert all(r.shard == jump(r.doc_id or 0, 3) and r.law == "key" for r in rows)
    assert sharding.shard_documents(empty_docs, 3).count() == 0


def stats_of(text):
    x = text or ""
    w = WORD.findall(x)
    g = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    cover = set()
    for i in range(len(w) - 4):
        if g[tuple(w[i : i + 5])] > 1:
            cover.update(range(i, i + 5))
    lines = [y for y in x.split("\n") if WORD.search(y)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", x)), len(lines) - len(set(lines)), len(cover)


def test_text_statistics(spark, odd_docs, empty_docs):
    extra = ["a b c d e a b c d e", "x x x x x x x", "a b c d e f a b c d e a b c d e g", "l\nl\n\n \nl # <|>", "a b c d"]
    docs = odd_docs.select("doc_id", "text").unionByName(
        spark.createDataFrame([(100 + i, t) for i, t in enumerate(extra)], "doc_id bigint, text string")
    )
    got = quality_rules.text_statistics(docs).collect()
    cols = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert Counter((r.doc_id, *(r[c] for c in cols)) for r in got) == Counter((r.doc_id, *stats_of(r.text)) for r in docs.collect())
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
    assert quality_rules.text_statistics(empty_docs).count() == 0


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="ab \n#", max_size=60), min_size=1, max_size=8))
def test_text_statistics_fuzz(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in quality_rules.text_statistics(docs).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == stats_of(t)


def test_rules_find_a_planted_conjunction(spark):
    rows = []
    for i in range(600):
        marks, caps = (i * 7) % 50, (i * 11) % 60
        rows.append((i, 100, 500, marks, 0, 0, 10, 0, caps, False, int(marks > 25 and caps > 30)))
    cols = "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, n_lines bigint, n_bangs bigint, n_upper bigint, base_failed boolean, bad int"
    data = spark.createDataFrame(rows, cols)
    rules = quality_rules.learn_rules(data)
    assert rules and all(r.precision >= 0.9 for r in rules)
    judged = quality_rules.apply_rules(data, rules).collect()
    wrong = sum(r.kept == bool(r.bad) for r in judged)
    assert wrong <= 0.05 * len(judged)
    assert quality_rules.learn_rules(data.filter("bad = 0")) == []
    assert quality_rules.learn_rules(data.limit(0)) == []


def test_quality_query_holds_out(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in QUERIES["op5_quality_rules"][0](spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").filter("quality = 0").collect()
    caught = [r.doc_id for r in labels if not rows[r.doc_id].kept]
    assert len(caught) >= 0.8 * len(labels)
    assert all(not (r.base_failed and r.kept) for r in rows.values())


def expected_chat(turns):
    """turns: (turn, role, text), one conversation."""
    ts = sorted(((t, r or "", x or "") for t, r, x in turns), key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
    flat = "".join(f"{r}\n{x}\n" for _, r, x in ts)
    loss = "".join(x for _, r, x in ts if r == "assistant")
    return len(ts), hashlib.sha256(flat.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


CHAT = "conv_id bigint, turn bigint, role string, text string, example string"
CASES = [
    (1, 0, "user", "\\### Assistant: </turn> ok"), (1, 1, "assistant", "\\### Assistant: </turn> ok"),
    (2, 0, "system", None), (2, 1, "assistant", ""), (2, 2, "assistant", "a\\b\\l\\h\\c </turn>\n### user: x"), (2, 3, "user", "tail"),
    (3, 0, "user", "alone"), (None, None, None, "n"), (None, 1, "assistant", "é😀"),
    (4, 1, "ro:le #<", "x: y"), (4, 1, "ro:le #<", "x: y"), (4, 0, "assistant", "\n\n"),
]


def test_chat_round_trip_and_masks(spark):
    turns = spark.createDataFrame([(*c, "clash") for c in CASES], CHAT)
    ex = chat.format_examples(turns)
    got = {r.conv_id: r for r in chat.conversation_digest(ex).collect()}
    by = {}
    for c, *t in CASES:
        by.setdefault(c, []).append(t)
    assert set(got) == set(by)
    for c, ts in by.items():
        r = got[c]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == expected_chat(ts)
    rows = ex.collect()
    assert sum(r.trainable for r in rows) == sum(c[2] == "assistant" for c in CASES)
    for r in rows:
        if r.trainable:
            assert r.formatted[r.loss_start + r.loss_length :] == "</turn>\n"
    assert chat.format_examples(turns.limit(0)).count() == 0


def test_url_keys_and_hosts(spark):
    urls = [
        ("https://User:pw@WWW.Example.org.:8080/a//b/?q=/x#f", "www.example.org"),
        ("http://[::1]:80/x", "[::1]"), ("ftp://h", "h"), ("not a url", ""), ("", ""), (None, None),
    ]
    df = spark.createDataFrame(urls, "url string, host string")
    rows = df.select("url", "host", url_filter.url_host(F.col("url")).alias("h"), url_filter.url_keys(F.col("url")).alias("k")).collect()
    assert all(r.h == r.host for r in rows)
    assert rows[0].k == ["www.example.org", "example.org", "org", "www.example.org/a", "www.example.org/a/b"]
    assert rows[3].k == [] and rows[5].k == []


def test_url_intervals_as_of(spark):
    d = dt.date
    entries = [
        ("block", "b.org", d(2024, 1, 5), True), ("block", "b.org", d(2024, 1, 5), True),
        ("block", "b.org", d(2024, 1, 10), False), ("block", "b.org", d(2024, 1, 20), True),
        ("block", "x.org", d(2024, 1, 3), True), ("block", "x.org", d(2024, 1, 3), False),
        ("allow", "a.b.org/ok", d(2024, 1, 1), True), ("block", "y.org", d(2024, 1, 1), False),
        ("block", "z.org", None, True), ("allow", "z.org", d(2024, 1, 1), True), ("block", "z.org", d(2024, 1, 1), True),
    ]
    e = spark.createDataFrame(entries, "list_name string, pattern string, entry_date date, active boolean")
    caps = [
        (1, "http://a.b.org/p", d(2024, 1, 4), True), (2, "http://a.b.org/p", d(2024, 1, 5), False),
        (3, "http://a.b.org/p", d(2024, 1, 9), False), (4, "http://a.b.org/p", d(2024, 1, 10), True),
        (5, "http://B.org", d(2024, 2, 1), False), (6, "http://a.b.org/ok/1", d(2024, 2, 1), True),
        (7, "http://x.org", d(2024, 1, 4), True), (8, None, d(2024, 1, 4), True), (9, "http://b.org", None, True),
        (10, "http://z.org/", d(2024, 1, 2), True), (10, "http://z.org/", d(2024, 1, 2), True), (None, "http://b.org", d(2024, 1, 6), False),
    ]
    c = spark.createDataFrame(caps, "page_id bigint, url string, fetched_on date, want boolean")
    got = url_filter.filter_captures(c.withColumn("kept", F.lit("clash")), e).collect()
    assert Counter((r.page_id, r.kept) for r in got) == Counter((r[0], r[3]) for r in caps)
    assert url_filter.filter_captures(c.limit(0), e).count() == 0
    assert all(r.kept for r in url_filter.filter_captures(c, e.limit(0)).collect())


@pytest.mark.parametrize("name", ["op2_jump_shards", "op6_chat_examples", "op10_url_filter"])
def test_sql_twins(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "conversations", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    fn, sql = QUERIES[name]
    df = fn(spark, "/root/testdata/sf0.001")
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert Counter(map(str, cur.fetchall())) == Counter(str(tuple(r[c] for c in names)) for r in df.collect())
