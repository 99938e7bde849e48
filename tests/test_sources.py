"""CSV input by name, provenance, errors and the curation flow from files."""

import pytest

from pairloom.plans.curation import curate_csv
from pairloom.sources import sinks
from pairloom.sources.preference_csv import list_csv_files, read_preference_csv, source_provenance
from pairloom.sources.sinks import read_view

HEADER = (
    "prompt_id,prompt,prompt_category,chosen,rejected,chosen_temperature,rejected_temperature,"
    "chosen_output_tokens,rejected_output_tokens,reading_time_s,is_tie"
)


def line(i, chosen="yes", time="5.0", tie="0"):
    return f"p{i},question {i},{'ab'[i % 2]},{chosen},no,0.7,0.2,{i},{i + 1},{time},{tie}"


def test_quotes_line_breaks_and_verbatim_words(spark, tmp_path):
    text = '"line one\nsays ""hi"", ok"'
    (tmp_path / "a.csv").write_text(f"{HEADER}\n{line(0, text)}\n{line(1, 'None', 'NaN', '')}\n{line(2, 'x', 'n/a', '1.0')}\n")
    rows = {r.prompt_id: r for r in read_preference_csv(spark, str(tmp_path)).collect()}
    assert len(rows) == 3
    assert rows["p0"].chosen == 'line one\nsays "hi", ok' and rows["p0"].is_tie == 0
    assert rows["p1"].chosen == "None" and rows["p1"].reading_time_s is None and rows["p1"].is_tie is None
    assert rows["p2"].is_tie == 1 and rows["p2"].reading_time_s is None and rows["p2"].chosen_output_tokens == 2


def test_files_are_aligned_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f"{HEADER}\n{line(0)}\n")
    (tmp_path / "b.csv").write_text("extra,chosen,prompt_id,is_tie\nmore,blue,p9,False\n")
    (tmp_path / "c.csv").write_text(f"{HEADER}\n")
    rows = {r.prompt_id: r for r in read_preference_csv(spark, str(tmp_path)).collect()}
    assert rows["p9"].chosen == "blue" and rows["p9"].extra == "more" and rows["p9"].is_tie == 0
    assert rows["p9"].prompt is None and rows["p0"].extra is None
    counts = {r.source_file.rsplit("/", 1)[1]: r.rows for r in source_provenance(spark, str(tmp_path)).collect()}
    assert counts == {"a.csv": 1, "b.csv": 1, "c.csv": 0}


def test_listing(spark, tmp_path):
    for name in ("b.csv", "a.csv", ".c.csv", "d.CSV", "x.txt"):
        (tmp_path / name).write_text(f"{HEADER}\n")
    (tmp_path / "nested.csv").mkdir()
    (tmp_path / "nested.csv" / "deep.csv").write_text(f"{HEADER}\n")
    names = [p.rsplit("/", 1)[1] for p in list_csv_files(spark, str(tmp_path))]
    assert names == ["a.csv", "b.csv"]
    assert len(list_csv_files(spark, str(tmp_path / "d.CSV"))) == 1
    with pytest.raises(ValueError):
        list_csv_files(spark, str(tmp_path / "x.txt"))
    with pytest.raises(FileNotFoundError):
        list_csv_files(spark, str(tmp_path / "missing"))
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        list_csv_files(spark, str(tmp_path / "empty"))


@pytest.mark.parametrize("as_table", [False, True])
def test_curation_from_csv(spark, tmp_path, as_table):
    source = tmp_path / "in"
    source.mkdir()
    lines = [line(i, tie="1" if i % 10 == 0 else "0", time="1" if i % 10 == 1 else "9") for i in range(50)]
    (source / "a.csv").write_text("\n".join([HEADER, *lines[:20]]) + "\n")
    (source / "b.csv").write_text("\n".join([HEADER, *lines[20:]]) + "\n")
    data = curate_csv(spark, str(source), table=str(tmp_path / "table") if as_table else None)
    row = data.metadata().first()
    assert (row.num_source_files, row.total_rows, row.ties_removed, row.too_fast) == (2, 50, 5, 5)
    assert (row.usable_pairs, row.val_pairs, row.sft_val_examples) == (40, 8, 8)
    assert row.val_categories == {"a": 4, "b": 4}
    paths = data.write_views(str(tmp_path / "views"))
    assert set(paths) == {"sft", "reward", "ppo"}
    assert read_view(spark, paths["sft"], "val").count() == 8
    assert data.view("reward", "train").columns == [
        "prompt",
        "chosen",
        "rejected",
        "category",
        "chosen_temperature",
        "rejected_temperature",
        "chosen_output_tokens",
        "rejected_output_tokens",
    ]


def test_rows_are_counted_while_written(spark, tmp_path):
    view = spark.range(100).selectExpr("id", "IF(id % 5 = 0, 'val', 'train') AS split").repartition(7)
    assert sinks.write_counted(view, f"{tmp_path}/view") == {"train": 80, "val": 20}
    assert sinks.read_view(spark, f"{tmp_path}/view", "val").count() == 20
    assert sinks.write_counted(view.where("id < 0"), f"{tmp_path}/none") == {"train": 0, "val": 0}
