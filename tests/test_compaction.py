"""Window files put together: the same lines, files of the size asked for, nothing to do the second time."""

import glob
import os
from collections import Counter

import pytest

from msgstream import compaction

TARGET = 1000


def write(path, window, batch, name, lines):
    folder = f"{path}/window_key={window}/batch_id={batch}"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.txt", "w") as out:
        out.writelines(f"{line}\n" for line in lines)


@pytest.fixture
def path(tmp_path):
    """A window of many small files, one of a large and a small file, one of a single file, one of empty files."""
    path = str(tmp_path / "windows")
    for k in range(60):
        write(path, "hot", k % 5, f"part-{k:03d}", [f"word{k}: {n}" for n in range(k % 9)])
    write(path, "mixed", 0, "large", ["x" * 99] * 30)
    write(path, "mixed", 1, "small", ["y: 1", "y: 1"])
    write(path, "single", 0, "small", ["z: 1"])
    for k in range(3):
        write(path, "empty", k, "none", [])
    return path


def lines(spark, path):
    rows = spark.read.schema("value string, window_key string, batch_id int").text(path)
    return Counter((r.window_key, r.value) for r in rows.collect())


def sizes(path, window):
    return sorted(os.path.getsize(f) for f in glob.glob(f"{path}/window_key={window}/*/*.txt"))


def test_lines_stay_and_files_grow(spark, path):
    before = lines(spark, path)
    assert compaction.compact_window_files(spark, path, TARGET) == 53
    assert lines(spark, path) == before
    hot = [size for size in sizes(path, "hot") if size]
    assert sum(size < TARGET / 2 for size in hot) <= 1 and max(hot) <= 1.5 * TARGET and len(hot) < 10
    assert len(sizes(path, "mixed")) == 2 and len(sizes(path, "single")) == 1 and sizes(path, "empty") == [0, 0, 0]
    files = sorted(glob.glob(f"{path}/**/*.txt", recursive=True))
    assert compaction.compact_window_files(spark, path, TARGET) == 0
    assert sorted(glob.glob(f"{path}/**/*.txt", recursive=True)) == files
    assert lines(spark, path) == before and not os.path.exists(f"{path}/{compaction.WORK}")


@pytest.mark.parametrize("after", ["before the mark", "within the exchange"])
def test_a_run_that_is_lost(spark, path, monkeypatch, after):
    before = lines(spark, path)
    with monkeypatch.context() as patch:
        calls = []

        def lost(spark, path):
            calls.append(path)
            if len(calls) > 1:
                raise RuntimeError("lost")

        patch.setattr(compaction, "finish_compaction", lost)
        with pytest.raises(RuntimeError):
            compaction.compact_window_files(spark, path, TARGET)
    if after == "before the mark":
        os.remove(f"{path}/{compaction.WORK}/ready")
    else:  # some files of one pack are gone already
        plan = spark.read.parquet(f"{path}/{compaction.WORK}/plan").orderBy("pack", "file").limit(3).collect()
        for row in plan:
            os.remove(row.file.removeprefix("file:"))
    compaction.compact_window_files(spark, path, TARGET)
    assert lines(spark, path) == before and compaction.compact_window_files(spark, path, TARGET) == 0
