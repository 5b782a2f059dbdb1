"""Files known by their content."""

from __future__ import annotations

import os
import shutil

import pytest

from tripflow.streaming import gather_new_content, ingest_new_files


class Inbox:
    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        self.source, self.gathered, self.manifest = (str(root / n) for n in ("source", "gathered", "manifest"))
        os.makedirs(self.source)

    def add(self, name, low, high):
        staged = str(self.root / "staged" / name.replace("/", "_"))
        self.spark.range(low, high, numPartitions=1).write.mode("overwrite").parquet(staged)
        part = next(f for f in os.listdir(staged) if f.endswith(".parquet"))
        os.makedirs(os.path.dirname(f"{self.source}/{name}"), exist_ok=True)
        shutil.copy(f"{staged}/{part}", f"{self.source}/{name}")

    def again(self, name, other):
        os.makedirs(os.path.dirname(f"{self.source}/{other}"), exist_ok=True)
        shutil.copy(f"{self.source}/{name}", f"{self.source}/{other}")

    def gather(self, **options):
        return {r.file for r in gather_new_content(self.spark, self.source, self.gathered, self.manifest, **options).collect()}

    def ingest(self):
        target = str(self.root / "target")
        ingest_new_files(self.spark, self.gathered, target, str(self.root / "checkpoint"), self.spark.range(0).schema)
        return sorted(r.id for r in self.spark.read.parquet(target).collect())


@pytest.mark.parametrize("block", [100, 10**9])
def test_a_file_sent_again_adds_nothing(spark, tmp_path, block):
    inbox = Inbox(spark, tmp_path)
    inbox.add("a.parquet", 0, 5)
    inbox.again("a.parquet", "deep/copy of a.parquet")
    inbox.add("b.parquet", 5, 9)
    assert inbox.gather(block_bytes=block) == {"a.parquet", "b.parquet"}
    assert inbox.ingest() == list(range(9))
    assert inbox.gather(block_bytes=block) == set()
    inbox.again("b.parquet", "b again.parquet")
    inbox.add("c.parquet", 9, 12)
    assert inbox.gather(block_bytes=block) == {"c.parquet"}
    assert inbox.ingest() == list(range(12))
    # a name that comes back with other content is new, its old content stays known
    inbox.again("b.parquet", "old b.parquet")
    inbox.add("b.parquet", 20, 22)
    assert inbox.gather(block_bytes=block) == {"b.parquet"}
    assert inbox.ingest() == [*range(12), 20, 21]
    assert len(os.listdir(inbox.gathered)) == 4


def test_files_looked_at_are_not_read_again(spark, tmp_path, monkeypatch):
    inbox = Inbox(spark, tmp_path)
    inbox.add("a.parquet", 0, 5)
    inbox.gather()
    asked = []
    plain = gather_new_content.__globals__["digest_blocks"]
    monkeypatch.setitem(
        gather_new_content.__globals__,
        "digest_blocks",
        lambda listing, *a: (asked.append({r.file for r in listing.files.collect()}), plain(listing, *a))[1],
    )
    inbox.add("b.parquet", 5, 6)
    inbox.gather()
    assert asked == [{"b.parquet"}]


def test_a_run_that_dies_is_repeated(spark, tmp_path, monkeypatch):
    inbox = Inbox(spark, tmp_path)
    inbox.add("a.parquet", 0, 5)
    with monkeypatch.context() as patch:
        patch.setitem(gather_new_content.__globals__, "put_in_place", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            inbox.gather()
    assert inbox.ingest() == list(range(5))
    assert inbox.gather() == {"a.parquet"}
    assert inbox.ingest() == list(range(5))


def test_an_empty_inbox(spark, tmp_path):
    inbox = Inbox(spark, tmp_path)
    assert inbox.gather() == set()
    assert inbox.gather() == set()
