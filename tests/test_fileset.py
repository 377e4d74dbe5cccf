"""Merging small files: large ones stay as they are, rows stay the same, a broken run is harmless."""

import hashlib
from pathlib import Path
from urllib.parse import unquote, urlparse

import pytest
from pyspark.sql import functions as F

from eventloom.sources.fileset import FileSet


def _rows(spark, a, b):
    return spark.range(a, b).select("id", F.concat(F.lit("type "), F.col("id") % 2).alias("kind"), F.sha2(F.col("id").cast("string"), 256).alias("text"))


def _digests(files):
    paths = [unquote(urlparse(r["uri"]).path) for r in files.files().collect()]
    return {p: hashlib.sha256(Path(p).read_bytes()).hexdigest() for p in paths}


@pytest.fixture
def files(spark, tmp_path):
    made = FileSet(spark, str(tmp_path / "set"), _rows(spark, 0, 1).schema, by=("kind",))
    made.add(_rows(spark, 0, 2_000).repartition(1))
    for i in range(3):
        made.add(_rows(spark, 2_000 + 100 * i, 2_100 + 100 * i).repartition(4))
    return made


def _sorted(df):
    return sorted(map(tuple, df.select("id", "kind", "text").collect()))


def test_only_small_files_are_rewritten(spark, files):
    before, rows = _digests(files), _sorted(files.read())
    large = {p: d for p, d in before.items() if Path(p).stat().st_size >= 20_000}
    assert len(large) == 2 and len(before) == 26
    assert files.merge_small(20_000, 1 << 20) == 24
    after = _digests(files)
    assert large.items() <= after.items() and len(after) == 4
    assert _sorted(files.read()) == rows == _sorted(_rows(spark, 0, 2_300))
    # Nothing is left to merge, and the version stays.
    version = files.version()
    assert files.merge_small(20_000, 1 << 20) == 0 and files.version() == version


def test_groups_keep_to_the_target(files):
    sizes = {r["file"]: r["bytes"] for r in files.files().collect()}
    groups = {}
    for r in files.plan(20_000, 15_000).collect():
        groups.setdefault((r["folder"], r["part"]), []).append(sizes[r["file"]])
    assert len(groups) > 2 and all(len(g) > 1 and sum(g) < 15_000 + 20_000 for g in groups.values())


@pytest.mark.parametrize("lost", ["lists", "commits"])
def test_a_broken_merge_changes_nothing(spark, tmp_path, files, lost):
    def fail(*_):
        raise RuntimeError("lost")

    before, rows = _digests(files), _sorted(files.read())
    broken = FileSet(spark, str(tmp_path / "set"), files.schema, by=("kind",))
    getattr(broken, lost).put = fail
    with pytest.raises(RuntimeError):
        broken.merge_small(20_000, 1 << 20)
    assert _digests(files) == before and _sorted(files.read()) == rows
    assert FileSet(spark, str(tmp_path / "set"), files.schema, by=("kind",)).merge_small(20_000, 1 << 20) == 24
    assert len(_digests(files)) == 4 and _sorted(files.read()) == rows


def test_an_empty_set(spark, tmp_path):
    empty = FileSet(spark, str(tmp_path / "e"), _rows(spark, 0, 1).schema)
    assert empty.version() == -1 and empty.read().count() == 0 and empty.merge_small() == 0
    empty.add(_rows(spark, 0, 0))
    empty.add(_rows(spark, 0, 5).coalesce(1))
    assert empty.read().count() == 5
