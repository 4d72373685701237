"""Manifest documents under the strict contract."""

from __future__ import annotations

import json

import pytest

from tidemark.operators import manifests as M

SHA = "0" * 64
FILE = {"symbol": "A", "path": "A.csv", "sha256": SHA, "row_count": 2, "first_date": "2024-01-02", "last_date": "2024-01-03"}
DOC = {
    "schema_version": 1, "snapshot_id": "s", "request_sha256": SHA, "dataset_id": "d", "provider": "p", "currency": "USD",
    "requested_start_date": "2024-01-01", "requested_end_date": "2024-01-31", "generated_at": "2024-02-01T00:00:00Z", "files": [FILE],
}


def doc(files=None, drop=(), **changes):
    out = {**DOC, **changes, **({"files": files} if files is not None else {})}
    return json.dumps({k: v for k, v in out.items() if k not in drop})


def file(drop=(), **changes):
    return {k: v for k, v in {**FILE, **changes}.items() if k not in drop}


CASES = [
    (doc(), None),
    (doc([]), None),
    (doc([FILE, file(symbol="B", path="B.csv")]), None),
    ("", M.MALFORMED), ("[1]", M.MALFORMED), ("{", M.MALFORMED), ('{"files":[],"files":[]}', M.MALFORMED), ("null", M.MALFORMED),
    (doc(zeta=1, extra=2), "unknown field extra"),
    (doc(drop=["provider", "currency"]), "missing field currency"),
    (doc(drop=["files"]), "missing field files"),
    (doc(provider=None), "mistyped field provider"),
    (doc(schema_version="one"), "mistyped field schema_version"),
    (doc(requested_end_date="soon"), "mistyped field requested_end_date"),
    (doc(requested_end_date="2024-02-30"), "mistyped field requested_end_date"),
    (doc(generated_at="never"), "mistyped field generated_at"),
    (doc(request_sha256=SHA[1:] + "A"), M.MF_REQUEST_SHA),
    (doc({}), "mistyped field files"),
    (doc([file(extra=1)]), "unknown field extra"),
    (doc([FILE, file(drop=["path"])]), "missing field path"),
    (doc([file(row_count="many")]), "mistyped field row_count"),
    (doc([file(sha256="x")]), M.MF_SHA),
    (doc([file(row_count=0)]), M.MF_ROWS),
    (doc([FILE, file(path="B.csv")]), M.MF_UNIQUE),
    (doc([FILE, file(symbol="B")]), M.MF_UNIQUE),
]


def test_every_rule_has_its_reason(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "i int, value string")
    got = {r.i: r.reject_reason for r in M.judge_documents(df).collect()}
    assert got == {i: want for i, (_, want) in enumerate(CASES)}


def test_strict_reading_raises_or_types(spark, tmp_path):
    (tmp_path / "good.json").write_text(doc() + "\n")
    row = M.read_strict(spark, f"{tmp_path}/good.json").first()
    assert row.files[0].row_count == 2 and str(row.requested_start_date) == "2024-01-01"
    (tmp_path / "bad.json").write_text(doc() + "\n" + doc(extra=1) + "\n")
    with pytest.raises(M.ManifestError, match="unknown field extra"):
        M.read_strict(spark, f"{tmp_path}/bad.json")


def test_written_header_is_compared(spark, tmp_path):
    (tmp_path / "h").write_text(doc(drop=["files"]) + "\n")
    M.check_written_header(spark, f"{tmp_path}/h", {"snapshot_id": "s", "schema_version": 1})
    with pytest.raises(M.ManifestError, match="differs in provider"):
        M.check_written_header(spark, f"{tmp_path}/h", {"provider": "q"})
    (tmp_path / "g").write_text(doc(drop=["files", "currency"]) + "\n")
    with pytest.raises(M.ManifestError, match="missing field currency"):
        M.check_written_header(spark, f"{tmp_path}/g", {})
