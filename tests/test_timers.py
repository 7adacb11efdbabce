"""Statuses of a stream: timers by the watermark alone, restarts, days read again, and the batch fold on a whole table."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cumload import catalog
from cumload.operators import resolve
from cumload.streaming import timers

SHAPE = "project long, id long, published timestamp, doc_type string, verdict string"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
DATA = "/root/testdata/sf0.001"


@pytest.fixture
def rocks(spark):
    spark.conf.set(PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield spark
    spark.conf.unset(PROVIDER)


class Run:
    """A folder of landed notices and a query over it that starts anew from its checkpoint each time."""

    def __init__(self, spark, where):
        self.spark, self.where, self.out = spark, str(where), []

    def land(self, *rows):
        self.spark.createDataFrame(rows, SHAPE).coalesce(1).write.mode("append").parquet(f"{self.where}/in")

    def changes(self):
        self.out.clear()
        stream = timers.timed_statuses(self.spark.readStream.schema(SHAPE).parquet(f"{self.where}/in"))
        keep = lambda batch, n: self.out.extend(tuple(r) for r in batch.collect())
        stream.writeStream.foreachBatch(keep).outputMode("update").option("checkpointLocation", f"{self.where}/cp").trigger(availableNow=True).start().awaitTermination()
        return sorted(self.out)


def at(*day):
    return dt.datetime(*day)


def test_consultations_time_out_by_the_watermark_alone(rocks, tmp_path):
    run = Run(rocks, tmp_path)
    run.land((1, 10, at(2020, 2, 29), "informacion_publica", None), (2, 20, at(2020, 3, 1), "informacion_publica", None), (3, 30, at(2020, 3, 2), "otro", None))
    assert run.changes() == [(1, "en_consulta", 10), (2, "en_consulta", 20), (3, "desconocido", 30)]
    # the same day read again changes nothing; a decision takes a project's timer away
    run.land((1, 10, at(2020, 2, 29), "informacion_publica", None), (2, 21, at(2020, 3, 5), "dia", "favorable"), (2, 22, at(2020, 3, 6), "dia", "no_aplica"), (None, 1, at(2020, 3, 6), "dia", "favorable"), (9, 9, None, "dia", "favorable"))
    assert run.changes() == [(2, "favorable", 21)]
    # other projects' notices move the day, and 24 whole months after a 29 February end on 1 March
    run.land((4, 40, at(2022, 3, 14), "modificacion", "favorable"))
    assert run.changes() == [(4, "favorable", 40)]
    run.land((5, 50, at(2022, 3, 16), "caducidad", None))
    assert run.changes() == [(1, "sin_resolucion", 10), (5, "caducado", 50)]
    # a consultation opens it again; a modification that came late but is dated first counts
    run.land((1, 11, at(2022, 3, 20), "informacion_publica", None), (4, 39, at(2022, 3, 10), "modificacion", "desfavorable"))
    assert run.changes() == [(1, "en_consulta", 11), (4, "desfavorable", 39)]


def test_a_stream_of_the_whole_table_ends_where_the_fold_does(rocks, tmp_path):
    notices = catalog._typed_notices(rocks, DATA).withColumn("published", F.col("published").cast("timestamp")).select("project", "id", "published", "doc_type", "verdict")
    notices.repartition(3).write.parquet(f"{tmp_path}/in")
    run = Run(rocks, tmp_path)
    run.changes()
    state = {}
    for project, status, said in run.out:
        state[project] = (status, said)
    newest = notices.agg(F.max("published")).first()[0] - dt.timedelta(days=14)
    want = resolve.status_fold(catalog._typed_notices(rocks, DATA), str(newest.date()))
    assert state == {r.project: (r.status, r.document_id) for r in want.collect()}


def test_another_state_store_is_refused(spark):
    with pytest.raises(ValueError):
        timers.timed_statuses(spark.createDataFrame([], SHAPE))
