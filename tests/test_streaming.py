import shutil

from pyspark.sql import functions as F

from textmill.operators import bytepair as bp
from textmill.plans.catalogue import QUERIES
from textmill.streaming import arrivals


def test_restart_takes_only_new_files(spark, docs, tmp_path):
    tokenizer = bp.train(docs("hello hello world"), 260)
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for step in range(2):
        docs(f" hello {step}\r\n").withColumn("doc_id", F.lit(step).cast("long")).write.mode("append").parquet(source)
        stream = arrivals.read_arrivals(spark, source, docs("").schema)
        arrivals.write_available(arrivals.clean_and_encode(stream, tokenizer), out, state).awaitTermination()
        rows = spark.read.parquet(out).orderBy("doc_id").collect()
        assert [r.text for r in rows] == [f"hello {k}" for k in range(step + 1)]
    decoded = spark.read.parquet(out).select(bp.decode(F.col("ids"), tokenizer).alias("d"), "text").collect()
    assert all(r.d == r.text for r in decoded)


def test_a_table_of_one_file_or_of_a_folder_of_files(spark, docs, tmp_path):
    rows = docs("a", "b", "c")
    rows.repartition(3).write.parquet(str(tmp_path / "many" / "documents.parquet"))
    rows.coalesce(1).write.parquet(str(tmp_path / "written"))
    (tmp_path / "one").mkdir()
    shutil.copy(next((tmp_path / "written").glob("*.parquet")), tmp_path / "one" / "documents.parquet")
    ids = {}
    for kind in ("many", "one"):
        got = QUERIES["stream_clean_encode"](spark, str(tmp_path / kind))
        ids[kind] = sorted((r.doc_id, r.ids) for r in got.collect())
    assert ids["many"] == ids["one"] == [(0, "97"), (1, "98"), (2, "99")]
