import pytest

from landing import price_file, price_line
from tidemill.__main__ import parser, run


def test_jobs_end_to_end(spark, tmp_path, capsys):
    price_file(tmp_path / "in", "2025-01", "a.csv", [price_line(), price_line(cnpj="2")])
    where = ["--warehouse", str(tmp_path / "wh")]

    def job(*args):
        code = run(spark, parser().parse_args([*args, *where]))
        return code, capsys.readouterr().out

    assert job("freshness") == (1, "error: newest load None\n")
    assert job("ingest", "--incoming", str(tmp_path / "in")) == (0, "1 files loaded in 1 batches\n")
    assert job("ingest", "--incoming", str(tmp_path / "in")) == (0, "0 files loaded in 0 batches\n")
    assert job("build")[0] == 0
    code, lines = job("check")
    assert code == 1
    failing = [line for line in lines.splitlines() if line.startswith("fail")]
    assert failing == ["fail  cnpj_revenda.length_equals: 1"]
    assert job("freshness")[0] == 0
    price_file(tmp_path / "in", "2025-02", "b.csv", [price_line(cnpj="3")])
    stream = ["stream", "--incoming", str(tmp_path / "in"), "--checkpoint", str(tmp_path / "cp")]
    assert job(*stream)[0] == 0
    assert job("build", "--full-refresh")[0] == 0
    assert job("check")[1].count("pass") == 19
    assert job("period", "--year", "2026", "--semester", "1") == (0, "2025-02: 1 rows\n")
    assert job("period", "--year", "2025", "--semester", "01") == (0, "2025-01: 2 rows\n")
    with pytest.raises(Exception, match="semester must be"):
        job("period", "--year", "2025", "--semester", "3")
    with pytest.raises(FileNotFoundError):
        job("period", "--year", "2020", "--semester", "1")
    assert job("compact") == (0, "batches 1 to 2 packed\n")
    assert job("compact") == (0, "no batches to pack\n")
    assert job("period", "--year", "2025", "--semester", "1") == (0, "2025-01: 2 rows\n")
    assert job("expire") == (0, "4 batch folders and 1 stored slices dropped\n")
    assert job("period", "--year", "2025", "--semester", "1") == (0, "2025-01: 2 rows\n")
    assert job("ingest", "--incoming", str(tmp_path / "in")) == (0, "0 files loaded in 0 batches\n")
