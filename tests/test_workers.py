"""Executors without the package on their path."""

import hashlib
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[1]
JOB = """
import sys
sys.path.insert(0, sys.argv[1])
from tidemill.plans.archive import archive_files
from tidemill.session import build_session
from tidemill.sources.file_units import checksum_files

spark = build_session("workers", "local[2]")
files = checksum_files(spark, sys.argv[2]).cache()
assert files.count() == 2
assert archive_files(files, sys.argv[2], sys.argv[3]) == 0
"""


def test_task_functions_need_no_installed_package(tmp_path):
    (tmp_path / "in").mkdir()
    for name in ("a.csv", "b.csv"):
        (tmp_path / "in" / name).write_text("some bytes")
    args = [sys.executable, "-c", JOB, str(REPO), str(tmp_path / "in"), str(tmp_path / "done")]
    done = subprocess.run(args, cwd=tmp_path, capture_output=True, text=True, timeout=180)
    assert done.returncode == 0, done.stderr[-2000:]
    assert sorted(p.name for p in (tmp_path / "done").iterdir()) == ["a.csv", "b.csv"]


LARGE = """
import sys
sys.path.insert(0, sys.argv[1])
from tidemill.session import build_session
from tidemill.sources.file_units import checksum_files

spark = build_session("large", "local[2]", **{"spark.driver.memory": "1g"})
print([tuple(r) for r in checksum_files(spark, sys.argv[2]).select("size_bytes", "file_checksum").collect()])
"""


def test_a_file_beyond_one_value_and_beyond_the_heap(tmp_path):
    size = 3 << 30
    (tmp_path / "in").mkdir()
    with (tmp_path / "in" / "sparse.csv").open("wb") as file:
        file.truncate(size)
    digest = hashlib.sha256()
    for _ in range(size >> 20):
        digest.update(bytes(1 << 20))
    args = [sys.executable, "-c", LARGE, str(REPO), str(tmp_path / "in")]
    done = subprocess.run(args, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert done.stdout.strip() == str([(size, digest.hexdigest())])
