import random
import string

from pyarrow.parquet import ParquetFile

from pairloom.session import stored
from pairloom.sources.sinks import read_view, write_view


def _codecs(folder):
    return {ParquetFile(f).metadata.row_group(0).column(0).compression for f in folder.rglob("*.parquet")}


def test_stored_texts_and_views_are_compressed_well(spark, tmp_path):
    view = spark.createDataFrame([("train", "a"), ("val", "b")], "split string, prompt string")
    write_view(view, f"{tmp_path}/view")
    assert _codecs(tmp_path / "view") == {"ZSTD"}
    assert sorted(stored(view, "view").collect()) == sorted(view.collect())


def test_a_text_that_comes_again_is_stored_once(spark, tmp_path):
    """More text than a dictionary has by default, in rows of both splits."""
    words = random.Random(1)
    texts = ["".join(words.choices(string.printable, k=40_000)) for _ in range(50)]
    rows = [("val" if i % 3 else "train", texts[i % 50]) for i in range(500)]
    view = spark.createDataFrame(rows, "split string, prompt string").coalesce(1)
    write_view(view, f"{tmp_path}/view")
    assert sum(f.stat().st_size for f in (tmp_path / "view").rglob("*.parquet")) < 5_000_000  # 20 MB of texts, 2 MB of them different
    found = read_view(spark, f"{tmp_path}/view")
    assert sorted(found.select("split", "prompt").collect()) == sorted(view.collect())
    assert [r.prompt for r in read_view(spark, f"{tmp_path}/view", "val").collect()] == [t for s, t in rows if s == "val"]
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
