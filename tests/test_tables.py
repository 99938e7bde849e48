import random
import string
from pathlib import Path

from pyspark.sql import functions as F
from shuffled import bytes_shuffled

from __spark_entry__ import queries
from pairloom.functions.text import packed, unpacked
from pairloom.operators import split, views
from pairloom.queries import catalog, tables
from pairloom.session import shuffles_freed, stored
from pairloom.sources import preference_csv, sinks


def _shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_updates_are_not_shuffled(spark, tmp_path):
    row = "1L l_orderkey, 1L l_linenumber, 2.0D l_quantity, 0.04D l_tax, 0.05D l_discount, 'N' l_returnflag"
    spark.sql(f"select {row}").write.parquet(f"{tmp_path}/lineitem.parquet")
    summed = tables.rollout_updates(spark, str(tmp_path)).groupBy("run_id", "step_id", "seq_id", "update_id").count()
    assert _shuffles(summed) == 1 and summed.count() == 4


def test_an_unread_text_does_not_move(spark, tmp_path):
    spark.sql("select 0L doc_id, 't' text, 'en' lang, 1L n_chars union all select 1L, 'u', 'en', 1L "
              "union all select 2L, 'v', 'en', 1L union all select 3L, 'w', 'en', 1L").write.parquet(f"{tmp_path}/documents.parquet")
    spark.sql("select id event_id, 'view' event_type, 1.0D value, '{\"k\": 5}' props from range(8)").write.parquet(
        f"{tmp_path}/events.parquet"
    )
    frames = [
        tables.preference_pairs(spark, str(tmp_path), order).orderBy("pair_id").collect()
        for order in (("prompt", "chosen", "rejected"), ("rejected", "prompt", "chosen"), ("chosen", "rejected", "prompt"))
    ]
    assert frames[0] == frames[1] == frames[2] and len(frames[0]) == 8


def _annotated(spark, folder, documents, events):
    spark.createDataFrame(documents, "doc_id long, text string, lang string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(events, "event_id long, event_type string, value double, props string").write.parquet(f"{folder}/events.parquet")
    return str(folder)


def _rows(df):
    return sorted(map(repr, df.collect()))


def test_whole_pairs_are_the_pairs(spark, tmp_path, monkeypatch):
    """Documents and events that come twice, lack an id or a text, and a prompt with more pairs than a cell holds."""
    monkeypatch.setattr(tables, "PAIRS_PER_CELL", 3)
    documents = [(i % 37 if i != 5 else None, f"text {i} é" * (i % 4) if i % 11 else None, "en", i) for i in range(42)]
    ids = [*range(60), *[42 * 10 * i + 3 for i in range(40)], 7, 7, None]
    events = [(i, "view", 1.0 + (k % 5), f'{{"k": {k % 20}}}') for k, i in enumerate(ids)]
    folder = _annotated(spark, tmp_path, documents, events)
    plain = tables.preference_pairs(spark, folder)
    whole = tables.whole_pairs(tables.pair_events(spark, folder), folder)
    assert whole.dtypes == plain.dtypes
    assert len(_rows(plain)) > 80 and _rows(whole) == _rows(plain)
    seeds = range(4)
    slim = [_rows(split.split_pairs(whole, seed=s, slim=plain)) for s in seeds]
    assert slim == [_rows(split.split_pairs(plain, seed=s)) for s in seeds]


def test_a_pair_moves_without_its_texts(spark, tmp_path):
    words = random.Random(1)
    documents = [(i, "".join(words.choices(string.printable, k=10_000)), "en", 10_000) for i in range(42)]
    events = [(i, "view", 10.0, '{"k": 5}') for i in range(840)]
    folder = _annotated(spark, tmp_path, documents, events)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        view = queries()["reward_view"](spark, folder)
        assert bytes_shuffled(view) < 4_000_000  # 25 MB of texts are returned
        assert view.count() == 840
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_distinct_prompts_move_without_their_pairs(spark, tmp_path):
    """Documents that come twice, lack an id or a text; the view is that of the pairs."""
    words = random.Random(3)
    texts = ["".join(words.choices(string.printable, k=10_000)) for _ in range(42)]
    documents = [(i % 37 if i != 5 else None, texts[i % 37] if i % 11 else None, "en", i % 37) for i in range(42)]
    documents = [d for d in documents if d[0] != 0]
    folder = _annotated(spark, tmp_path, documents, [(i, "view", 10.0, '{"k": 5}') for i in range(840)])
    labelled = stored(split.split_pairs(tables.preference_pairs(spark, folder)).repartition(8), "labelled")
    prompts = tables.distinct_prompts(labelled, folder)
    assert bytes_shuffled(prompts) < 500_000  # 630 KB of prompts come from 8 tasks otherwise
    assert _rows(prompts) == _rows(views.prompt_view(labelled)) and prompts.count() > 10


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {x for x in files.mkString("\n").split("\n") if "/shuffle_" in x}


def test_shuffle_files_go_when_a_table_is_written(spark, tmp_path):
    before = _shuffle_files(spark)
    rows = spark.range(1000).repartition(4, "id")
    with shuffles_freed(spark):
        assert stored(rows, "freed").count() == 1000
    sinks.write_view(rows.selectExpr("id", "'val' split").repartition(3, "id"), f"{tmp_path}/view")
    assert not _shuffle_files(spark) - before


def test_annotation_files_hold_equal_texts_side_by_side(spark, tmp_path):
    words = random.Random(4)
    documents = [(i, "".join(words.choices(string.ascii_letters, k=3_000)), "en", 3_000) for i in range(84)]
    events = [(i, ("view", "error", "purchase", None)[i % 4], 10.0, '{"k": 5}') for i in range(1680)]
    folder = _annotated(spark, tmp_path, documents, events)
    written = catalog._csv_folder("a test", folder)
    size = sum(f.stat().st_size for f in Path(written.removeprefix("file:")).glob("*.gz"))
    assert size < 3_500_000  # 11 MB of texts
    ids = preference_csv.read_preference_csv(spark, written).select("pair_id", "prompt", "chosen", "rejected", "rejected_temperature", "note")
    pairs = tables.preference_pairs(spark, folder).where("event_type IS NOT NULL")
    plain = pairs.selectExpr(
        "string(pair_id) pair_id", "prompt", "chosen", "rejected",
        "if(event_type = 'purchase', null, rejected_temperature) rejected_temperature", "if(event_type = 'error', 'error', null) note",
    )
    assert _rows(ids) == _rows(plain) and ids.count() == 1260
    assert preference_csv.source_provenance(spark, written).agg({"rows": "sum"}).first()[0] == 1260


def test_packed_texts_come_back(spark):
    texts = ["", "a", "é中\n" * 5_000, None] * 200
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    moved = rows.select("i", packed(F.col("t")).alias("t"))
    assert _rows(unpacked(moved, ["t"], rows=7)) == _rows(rows)
    assert moved.where("length(t) > 1000").isEmpty()
