"""The command line, driven in-process with the test session."""

import os

from bigwig_writer import write_bigwig
from covtab.__main__ import main


def test_convert_validate_inspect(spark, tmp_path, capsys):
    d = tmp_path / "rnaseq" / "S" / "G" / "bigwig"
    d.mkdir(parents=True)
    write_bigwig(str(d / "a.bw"), [("chr22", 100_000), ("chr1", 1000)],
                 {"chr22": [(s, s + 50, 1.0) for s in range(0, 90_000, 100)], "chr1": [(0, 9, 2.0)]})
    out = str(tmp_path / "out")
    table = f"{out}/region=chr22_1000_2000"
    assert main(["convert-dir", str(d), out, "--chrom", "chr22", "--pos_start", "1000",
                 "--pos_end", "2000"], spark) == 0
    assert main(["validate", table, "--expected-chrom", "22", "--expected-pos-start", "1000",
                 "--expected-pos-end", "2000"], spark) == 0
    assert main(["validate", table, "--expected-chrom", "1"], spark) == 1
    assert main(["inspect", str(d / "a.bw"), "--chrom", "22", "--start", "500", "--n", "3"], spark) == 0
    assert main(["inspect", str(d / "a.bw"), "--chrom", "chrNOPE"], spark) == 1
    assert main(["inspect", str(d)], spark) == 0
    assert main(["null-report", table], spark) == 0
    man = str(tmp_path / "manifest")
    assert main(["find-dirs", "--root", str(tmp_path / "rnaseq"), "--out", man], spark) == 0
    assert main(["convert-study", "--input_base", str(tmp_path / "rnaseq"), "--study", "S",
                 str(tmp_path / "o2"), "--dry-run"], spark) == 0
    text = capsys.readouterr().out
    planned = [x.removeprefix("Will write: ") for x in text.splitlines() if "Will write" in x]
    assert main(["convert-study", "--input_base", str(tmp_path / "rnaseq"), "--study", "S",
                 str(tmp_path / "o2")], spark) == 0
    assert len(planned) == 1 and os.path.isdir(planned[0])


def test_cli_prints_every_row(spark, tmp_path, capsys):
    d = tmp_path / "bw"
    d.mkdir()
    for k in range(30):
        (d / f"bad{k:02d}.bw").write_text("junk")
    assert main(["inspect", str(d)], spark) == 1
    text = capsys.readouterr().out
    assert all(f"bad{k:02d}.bw" in text for k in range(30))


def test_cli_errors(spark, tmp_path):
    d, out = tmp_path / "d", str(tmp_path / "out")
    d.mkdir()
    assert main(["convert-dir", str(tmp_path / "missing"), out], spark) == 1
    assert main(["convert-dir", str(d), out, "--chrom", "Y"], spark) == 1
    assert not os.path.isdir(out)
