"""The command line on the samples."""

from pathlib import Path

import pytest
import samples
from farebox.__main__ import REPORTS, main


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("command")
    raw = samples.write_all(base / "raw")

    def options(paths):
        return [part for name, path in paths.items() for part in (f"--{name.replace('_', '-')}", path)]

    main(["convert", "--out", str(base / "converted"), *options(raw)])
    folders = {"gps_trips": "trip_2015", "zoned_trips": "trip_2024", "zones": "zones"}
    converted = {name: str(base / "converted" / folder) for name, folder in folders.items()}
    return {"csv": options(raw), "parquet": options(converted)}


@pytest.mark.parametrize(("job", "variant"), [(job, v) for job, variants in REPORTS.items() for v in variants])
def test_reports_agree_on_both_formats(inputs, tmp_path, job, variant):
    texts = {}
    if variant == "text":
        with pytest.raises(SystemExit):
            main([job, "--id", "600", "--fmt", "parquet", "--variant", "text", "--out", str(tmp_path / "no"), *inputs["parquet"]])
        inputs, plain = {"csv": inputs["csv"]}, {"q1": "histogram", "q2": "df"}[job]
        main([job, "--id", "600", "--fmt", "csv", "--variant", plain, "--out", str(tmp_path / "plain"), *inputs["csv"]])
        texts["parquet"] = sorted("".join(p.read_text() for p in (tmp_path / "plain").glob("part-*.csv")).splitlines())
    for fmt, options in inputs.items():
        out = tmp_path / fmt
        main([job, "--id", "600", "--fmt", fmt, "--variant", variant, "--out", str(out), *options])
        texts[fmt] = sorted("".join(p.read_text() for p in Path(out).glob("part-*.csv")).splitlines())
    assert texts["csv"] == texts["parquet"] and len(texts["csv"]) >= 2


def test_a_report_asks_only_for_its_tables(inputs, tmp_path):
    paths = dict(zip(inputs["csv"][::2], inputs["csv"][1::2]))
    gps = ["--gps-trips", paths["--gps-trips"]]
    main(["q1", "--id", "600", "--fmt", "csv", "--out", str(tmp_path / "q1"), *gps])
    with pytest.raises(SystemExit):
        main(["q3", "--id", "600", "--fmt", "csv", "--out", str(tmp_path / "q3"), *gps])


def test_bad_calls(inputs, tmp_path):
    for extra in (["q3"], ["q3", "--id", "600", "--variant", "rdd"]):
        with pytest.raises(SystemExit):
            main([*extra, "--out", str(tmp_path), *inputs["csv"]])
