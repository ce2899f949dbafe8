from __future__ import annotations

import hashlib
import json
import shutil

import pytest

from tagwright import LabelEngine
from tagwright.functions.columns import megabytes
from tagwright.sources import files
from tagwright.sources.tables import create_views, load_tables
from tests.star import as_dicts

SIZES = {
    "verified_contracts/a.parquet": 3,
    "verified_contracts/b.parquet": 0,
    "contract_deployments/a.parquet": 150_000,
    "contract_deployments/note.txt": 9,
    "compiled_contracts/c d.parquet": 70_000,
    "compiled_contracts/100%25.parquet": 7,
    "sources/x.parquet": 5,
    "stray.parquet": 4,
    "sources/deep/y.parquet": 6,
}


@pytest.fixture()
def folder(tmp_path):
    root = tmp_path / "data"
    for name, size in SIZES.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(bytes(range(1, 251)) * (size // 250) + b"x" * (size % 250))
    return str(root)


def test_listing_has_table_files_and_empty_ones(spark, folder):
    got = {
        f"{r['table_name']}/{r['file_name']}": r["length"]
        for r in as_dicts(files.file_listing(spark, folder))
    }
    assert got == {
        "verified_contracts/a.parquet": 3,
        "verified_contracts/b.parquet": 0,
        "contract_deployments/a.parquet": 150_000,
        "compiled_contracts/c d.parquet": 70_000,
        "compiled_contracts/100%25.parquet": 7,
        "sources/x.parquet": 5,
    }


def test_copies_further_down_do_not_count(spark, tmp_path, monkeypatch):
    sizes = {
        "data/verified_contracts/a.parquet": 3,
        "data/backup/verified_contracts/a.parquet": 70,
        "data/backup/data/verified_contracts/zz.parquet": 5,
        "data/data/verified_contracts/b.parquet": 6,
    }
    for name, size in sizes.items():
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"x" * size)
    for root in ("data", "data/", "data/."):
        listing = as_dicts(files.file_listing(spark, f"{tmp_path}/{root}"))
        assert [(r["table_name"], r["file_name"], r["length"]) for r in listing] == [
            ("verified_contracts", "a.parquet", 3)
        ]
    digests = as_dicts(files.file_digests(spark, f"{tmp_path}/data/."))
    assert [r["sha256"] for r in digests] == [hashlib.sha256(b"xxx").hexdigest()]


def test_digests_of_whole_and_streamed_files(spark, folder, monkeypatch):
    root = files.qualified(spark, folder)
    want = {
        name.split("/", 1)[1]: hashlib.sha256((bytes(range(1, 251)) * (size // 250) + b"x" * (size % 250))).hexdigest()
        for name, size in SIZES.items()
        if name.count("/") == 1 and name.endswith(".parquet") and not name.endswith("/a.parquet")
    }
    for whole in (files.WHOLE_BYTES, 6, 0):  # all whole, some streamed, all that are not empty
        monkeypatch.setattr(files, "WHOLE_BYTES", whole)
        got = as_dicts(files.file_digests(spark, folder))
        assert len(got) == 6 and all(r["path"].startswith("file:") for r in got), root
        names = {r["path"].rsplit("/", 1)[1]: r["sha256"] for r in got}
        assert {n: d for n, d in names.items() if n != "a.parquet"} == want


def test_digest_of_a_file_over_two_gigabytes(spark, tmp_path):
    path = tmp_path / "data" / "verified_contracts" / "long.parquet"
    path.parent.mkdir(parents=True)
    size = 2**31 + 12_345
    with open(path, "wb") as file:  # a hole takes no disk
        file.truncate(size)
        file.seek(2**31)
        file.write(b"end")
    want = hashlib.sha256()
    with open(path, "rb") as file:
        while piece := file.read(1 << 20):
            want.update(piece)
    digests = as_dicts(files.file_digests(spark, str(tmp_path / "data")))
    assert [r["sha256"] for r in digests] == [want.hexdigest()]


def test_digests_of_the_given_tables(spark, tmp_path):
    """Real files: each table of the test data in a folder of its own."""
    for table in ("documents", "orders", "pages"):
        (tmp_path / table).mkdir()
        shutil.copyfile(f"/root/testdata/sf0.01/{table}.parquet", tmp_path / table / "0.parquet")
    got = {r["path"].split("/")[-2]: r["sha256"] for r in as_dicts(files.file_digests(spark, str(tmp_path)))}
    want = {}
    for table in ("documents", "orders", "pages"):
        with open(f"/root/testdata/sf0.01/{table}.parquet", "rb") as file:
            want[table] = hashlib.sha256(file.read()).hexdigest()
    assert got == want


def test_required_tables(spark, folder):
    listing = files.file_listing(spark, folder)
    assert files.check_required(listing) == {
        "verified_contracts": 2,
        "contract_deployments": 1,
        "compiled_contracts": 2,
    }
    some = listing.filter("table_name <> 'compiled_contracts'")
    with pytest.raises(FileNotFoundError, match="compiled_contracts"):
        files.check_required(some)


def test_engine_needs_all_tables(spark, folder, tmp_path):
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        LabelEngine.open(spark, str(tmp_path / "empty"), "registry")


def test_manifest(spark, tmp_path):
    path = tmp_path / "manifest.json"
    manifest = {
        "dateStr": "2024-05-01",
        "files": {
            "verified_contracts": ["verified_contracts/a.parquet", "verified_contracts/b.parquet"],
            "contract_deployments": [],
            "sources": ["sources/x.parquet"],
        },
    }
    path.write_text(json.dumps(manifest, indent=2))
    rows = as_dicts(files.manifest_files(files.read_manifest(spark, str(path))))
    assert sorted((r["table_name"], r["file_name"] or "") for r in rows) == [
        ("compiled_contracts", ""),
        ("contract_deployments", ""),
        ("verified_contracts", "a.parquet"),
        ("verified_contracts", "b.parquet"),
    ]
    assert {r["date_str"] for r in rows} == {"2024-05-01"}


def wanted(spark, *names):
    rows = [tuple(n.split("/")) if n else ("sources", None) for n in names]
    return spark.createDataFrame(rows, "table_name string, file_name string")


def test_reconciliation(spark, folder):
    listing = files.file_listing(spark, folder)
    want = wanted(
        spark,
        "verified_contracts/a.parquet",
        "verified_contracts/b.parquet",
        "verified_contracts/gone.parquet",
        "compiled_contracts/a.parquet",  # exists in another table only
        None,
    )
    got = {(r["table_name"], r["file_name"]): r["problem"] for r in
           as_dicts(files.reconcile(want, listing))}
    assert got == {
        ("verified_contracts", "b.parquet"): "empty",
        ("verified_contracts", "gone.parquet"): "missing",
        ("compiled_contracts", "a.parquet"): "missing",
    }
    assert not files.is_complete(want, listing)
    assert files.is_complete(wanted(spark, "verified_contracts/a.parquet"), listing)


def test_expected_sizes(spark, folder):
    listing = files.file_listing(spark, folder)
    rows = [
        ("verified_contracts", "a.parquet", 3),
        ("verified_contracts", "b.parquet", 0),  # empty on both sides is not complete
        ("contract_deployments", "a.parquet", 149_999),
        ("sources", "x.parquet", None),
        ("sources", "gone.parquet", 5),
    ]
    expected = spark.createDataFrame(
        rows, "table_name string, file_name string, expected_length long"
    )
    got = [r["complete"] for r in sorted(
        as_dicts(files.with_completeness(expected, listing)),
        key=lambda r: rows.index((r["table_name"], r["file_name"], r["expected_length"])),
    )]
    assert got == [True, False, False, False, False]


def test_summary_rounds_the_total_of_bytes(spark, folder):
    got = {
        r["table_name"]: (r["file_count"], r["size_mb"])
        for r in as_dicts(files.file_summary(files.file_listing(spark, folder)))
    }
    assert got["contract_deployments"] == (1, 0.1)  # 0.143
    assert got["compiled_contracts"][1] == 0.1  # 0.067
    assert got["total"][1] == 0.2  # 0.210, not the sum of the rounded parts with 0.0
    assert got["verified_contracts"] == (2, 0.0)


def test_summary_can_list_tables_without_files(spark, folder):
    listing = files.file_listing(spark, folder).filter("table_name = 'sources'")
    got = {
        r["table_name"]: (r["file_count"], r["size_mb"])
        for r in as_dicts(files.file_summary(listing, ["sources", "compiled_contracts"]))
    }
    assert got == {"sources": (1, 0.0), "compiled_contracts": (0, 0.0), "total": (1, 0.0)}


def test_rounding_is_half_to_even(spark):
    sizes = [int(0.25 * 1048576), int(0.75 * 1048576)]
    df = spark.createDataFrame([(s,) for s in sizes], "size long")
    assert [r[0] for r in df.select(megabytes(df["size"])).collect()] == [0.2, 0.8]


def test_digests(spark, folder):
    got = {
        r["path"].rsplit("/", 2)[-2] + "/" + r["path"].rsplit("/", 1)[-1]: r["sha256"]
        for r in as_dicts(files.file_digests(spark, folder))
    }
    raw = open(f"{folder}/contract_deployments/a.parquet", "rb").read()
    assert got["contract_deployments/a.parquet"] == hashlib.sha256(raw).hexdigest()
    assert "deep/y.parquet" not in got


def test_views(star, tmp_path):
    star.write(str(tmp_path))
    star.write(str(tmp_path))  # a second file per table
    tables = load_tables(star.spark, str(tmp_path))
    create_views(tables)
    create_views(tables)  # replaces
    n = star.spark.sql(
        "select count(*) from verified_contracts vc join contract_deployments cd "
        "on vc.deployment_id = cd.id"
    ).first()[0]
    assert n == 4 * 11
    engine = LabelEngine.open(star.spark, str(tmp_path), "registry")
    assert [r["n_rows"] for r in engine.table_counts().collect()] == [26, 16, 8]
