import pyarrow as pa
import pytest

from casona.llm import shared, simhash
from casona.llm.shared import text_pieces


@pytest.mark.parametrize("size", [1, 10, 1 << 22])
def test_pieces_of_a_batch_are_the_batch(monkeypatch, size):
    monkeypatch.setattr(shared, "PIECE_BYTES", size)
    batch = pa.record_batch({"id": [1, 2, 3, 4], "text": ["a" * 9, None, "", "é"]})
    pieces = list(text_pieces(batch.slice(1), 1))
    assert [t for _, texts in pieces for t in texts] == [None, b"", "é".encode()]
    assert [i for p, _ in pieces for i in p.column(0).to_pylist()] == [2, 3, 4]
    assert list(text_pieces(batch.slice(0, 0), 1)) == []


def test_settings_of_the_session_stay(spark, edge):
    before = spark.sparkContext.getConf().getAll(), spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    simhash.fingerprints(edge).count()
    assert before == (spark.sparkContext.getConf().getAll(), spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))


def test_rows_of_files_are_numbered_without_a_copy(spark, tmp_path):
    rows = spark.range(1000).repartition(5).withColumnRenamed("id", "doc_id")
    rows.write.parquet(str(tmp_path / "t"))
    read = spark.read.parquet(str(tmp_path / "t"))
    numbered = shared.with_row_numbers(read, "__row")
    first, again = ({r["__row"]: r["doc_id"] for r in x.collect()} for x in (numbered, numbered))
    assert len(first) == 1000 and first == again and numbered.columns == ["doc_id", "__row"]
    assert shared.with_row_numbers(read.where("doc_id < 0"), "__row").count() == 0
    other = shared.with_row_numbers(spark.range(10).selectExpr("id + 1 as doc_id"), "__row")
    assert other.select("__row").distinct().count() == 10


def test_rows_that_are_multiplied_get_numbers_of_their_own(spark, tmp_path):
    from pyspark.sql import functions as F

    spark.range(100).withColumnRenamed("id", "doc_id").repartition(3).write.parquet(str(tmp_path / "t"))
    read = spark.read.parquet(str(tmp_path / "t"))
    twice = spark.createDataFrame([(k, n) for k in range(100) for n in range(2)], "doc_id long, n int")
    named = read.withColumns({f"__{c}": F.lit("x") for c in ("path", "index", "first")})
    for rows, count in ((read.join(twice, "doc_id"), 200), (read.withColumn("n", F.explode(F.array(F.lit(1), F.lit(2)))), 200), (read.union(read), 200), (read.alias("a").join(read.alias("b"), "doc_id"), 100), (read.sample(True, 3.0, 1), None), (read.where("doc_id > 49").select("doc_id", (F.col("doc_id") * 2).alias("m")), 50), (named, 100)):
        numbered = shared.with_row_numbers(rows, "__row")
        found = [r["__row"] for r in numbered.collect()]
        assert len(found) == len(set(found)) and (count is None or len(found) == count) and numbered.columns == [*rows.columns, "__row"]
    assert named.columns == ["doc_id", "__path", "__index", "__first"] and {r["__path"] for r in shared.with_row_numbers(named, "__row").collect()} == {"x"}
