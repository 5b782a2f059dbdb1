"""Landing at scale: listing level by level, files in blocks, manifests and repair."""

from __future__ import annotations

import hashlib
import os
import shutil

import duckdb
import pytest

import __spark_entry__ as registry
from tripflow.sources import (
    LandingError,
    by_dataset,
    file_blocks,
    hash_trees,
    land_files,
    landing,
    repair_copy,
    require_match,
    verify_copy,
)


@pytest.fixture
def source(tmp_path):
    root = tmp_path / "source"
    contents = {
        "big.bin": bytes(range(256)) * 41 + b"end",
        "exact.bin": b"x" * 3000,
        "small.bin": b"s",
        "empty.bin": b"",
    }
    contents |= {f"top/{'/'.join('abcdef'[:d])}/f{d}_{i}.bin": f"{d}{i}".encode() * d for d in range(1, 6) for i in range(3)}
    for name, content in contents.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(content)
    (root / "no files").mkdir()
    return str(root), contents


def files_below(root) -> dict[str, bytes]:
    return {
        os.path.relpath(os.path.join(folder, name), root): open(os.path.join(folder, name), "rb").read()
        for folder, _, names in os.walk(root)
        for name in names
    }


def test_every_folder_is_listed_once_and_by_levels(spark, source):
    root, contents = source
    listing = landing.take_listing(spark, root)
    assert {r.file: r.length for r in listing.files.collect()} == {n: len(c) for n, c in contents.items()}
    assert (listing.count, listing.bytes) == (len(contents), sum(map(len, contents.values())))
    assert listing.longest == max(map(len, contents.values()))
    # The listing is a stored table: using it lists nothing again.
    assert all("/tripflow-listing-" in f for f in listing.files.inputFiles())


def test_folders_below_one_top_folder_are_dealt_over_tasks(spark, tmp_path):
    for i in range(40):
        (tmp_path / "r" / "only" / f"d{i}").mkdir(parents=True)
        (tmp_path / "r" / "only" / f"d{i}" / "f").write_bytes(b"1")
    listing = landing.take_listing(spark, str(tmp_path / "r"))
    deepest = sorted(f for f in listing.files.inputFiles() if "/2/" in f)
    assert listing.count == 40 and len(deepest) > 1


def test_a_root_without_files_and_one_that_is_not_there(spark, tmp_path):
    assert landing.take_listing(spark, str(tmp_path)).count == 0
    assert verify_copy(spark, str(tmp_path), str(tmp_path)).count() == 0
    with pytest.raises(Exception, match="FileNotFoundError"):
        landing.take_listing(spark, str(tmp_path / "nothing"))


@pytest.mark.parametrize("block", [1000, 128, landing.BLOCK_BYTES])
def test_files_are_landed_in_blocks(spark, source, tmp_path, block):
    root, contents = source
    landed = str(tmp_path / "landed")
    manifest = land_files(spark, root, landed, block_bytes=block)
    assert files_below(landed) == contents
    expected = {
        (name, len(c), at, hashlib.md5(c[at : at + block]).hexdigest())
        for name, c in contents.items()
        for at in range(0, max(len(c), 1), block)
    }
    assert {(r.file, r.length, r.start, r.md5) for r in manifest.collect()} == expected
    assert {tuple(r) for r in file_blocks(spark, landed, block).collect()} == expected
    verified = verify_copy(spark, root, landed, manifest=manifest)
    assert {r.status for r in verified.collect()} == {"match"}


def test_a_manifest_is_checked_without_the_source(spark, source, tmp_path):
    root, contents = source
    landed = tmp_path / "landed"
    manifest = land_files(spark, root, str(landed), block_bytes=1000)
    (landed / "small.bin").unlink()
    (landed / "exact.bin").write_bytes(b"x" * 2999 + b"y")
    verified = verify_copy(spark, str(tmp_path / "gone"), str(landed), manifest=manifest)
    status = {r.file: r.status for r in verified.collect()}
    assert (status["small.bin"], status["exact.bin"], status["big.bin"]) == ("missing", "mismatch", "match")
    with pytest.raises(LandingError):
        require_match(verified)


def test_only_lost_blocks_are_copied_again(spark, source, tmp_path):
    root, contents = source
    landed = tmp_path / "landed"
    manifest = land_files(spark, root, str(landed), block_bytes=1000)
    damaged = bytearray(contents["big.bin"])
    damaged[2500] ^= 1
    damaged[7100] ^= 1
    (landed / "big.bin").write_bytes(bytes(damaged))
    (landed / "exact.bin").write_bytes(b"x" * 1500)
    (landed / "small.bin").unlink()
    again = {(r.file, r.start) for r in repair_copy(spark, root, str(landed), manifest).collect()}
    assert again == {("big.bin", 2000), ("big.bin", 7000), *[("exact.bin", s) for s in (0, 1000, 2000)], ("small.bin", 0)}
    assert files_below(landed) == contents
    assert repair_copy(spark, root, str(landed), manifest).count() == 0


def test_repair_refuses_a_source_that_changed(spark, source, tmp_path):
    root, contents = source
    landed = tmp_path / "landed"
    manifest = land_files(spark, root, str(landed), block_bytes=1000)
    (landed / "exact.bin").write_bytes(b"?" * 3000)
    with open(f"{root}/exact.bin", "wb") as file:
        file.write(b"z" * 3000)
    with pytest.raises(LandingError, match="exact.bin"):
        repair_copy(spark, root, str(landed), manifest)


def test_a_failing_landing_leaves_no_part_files(spark, source, tmp_path):
    root, contents = source
    landed = tmp_path / "landed"
    (landed / "small.bin" / "in the way").mkdir(parents=True)  # its rename cannot succeed
    with pytest.raises(Exception, match="small.bin"):
        land_files(spark, root, str(landed), block_bytes=1000)
    assert not [name for name in files_below(landed) if "/." in f"/{name}"]


def test_hash_trees_tell_files_apart(spark, source, tmp_path):
    root, contents = source
    manifest = land_files(spark, root, str(tmp_path / "landed"), block_bytes=1000)
    roots = {r.file: (r.length, r.blocks, r.root) for r in hash_trees(manifest).collect()}
    assert roots.keys() == contents.keys()
    for name, c in contents.items():
        blocks = [c[at : at + 1000] for at in range(0, max(len(c), 1), 1000)]
        joined = "".join(hashlib.md5(b).hexdigest() for b in blocks)
        assert roots[name] == (len(c), len(blocks), hashlib.md5(joined.encode()).hexdigest())
    same = hash_trees(file_blocks(spark, str(tmp_path / "landed"), 1000))
    assert {r.file: r.root for r in same.collect()} == {name: v[2] for name, v in roots.items()}


def test_a_folder_counts_as_one_dataset(spark, source, tmp_path):
    root, contents = source
    landed = tmp_path / "landed"
    land_files(spark, root, str(landed))
    top = sum(len(c) for name, c in contents.items() if name.startswith("top/"))
    rows = {r.file: r for r in by_dataset(verify_copy(spark, root, str(landed))).collect()}
    assert rows.keys() == {"big.bin", "exact.bin", "small.bin", "empty.bin", "top"}
    assert {r.status for r in rows.values()} == {"match"}
    assert (rows["top"].files, rows["top"].source_length, rows["top"].landed_length) == (15, top, top)
    # One file of many is enough, whether it is lost, damaged or too much.
    first = next(name for name in contents if name.startswith("top/"))
    for change in ("lost", "damaged", "extra"):
        again = tmp_path / change
        shutil.copytree(landed, again)
        if change == "lost":
            (again / first).unlink()
        else:
            (again / (first if change == "damaged" else "top/new.bin")).write_bytes(b"?")
        status = {r.file: r.status for r in by_dataset(verify_copy(spark, root, str(again))).collect()}
        assert status.pop("top") == "mismatch" and set(status.values()) == {"match"}
    shutil.copytree(landed, tmp_path / "gone", ignore=shutil.ignore_patterns("top"))
    status = {r.file: r.status for r in by_dataset(verify_copy(spark, root, str(tmp_path / "gone"))).collect()}
    assert status["top"] == "missing"


def test_registered_verify_copy_takes_tables_that_are_folders(spark, sf_dir, tmp_path):
    root = tmp_path / "tables"
    shutil.copytree(sf_dir, root, copy_function=shutil.copyfile)
    root.chmod(0o755)
    for name in ("documents", "lineitem"):
        (root / f"{name}.parquet").unlink()
        given = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        given.repartition(3).write.parquet(f"{root}/{name}.parquet")
    found = registry.trip_queries()["verify_copy"](spark, str(root))
    expected = duckdb.execute(registry.trip_oracle_sql()["verify_copy"]).fetchall()
    assert sorted(map(tuple, found.collect())) == sorted(expected)
