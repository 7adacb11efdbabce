"""Statuses of a stream of notices, with a timer for each open consultation.

The state of a project is what its status depends on: its last decision or
lapse, first granted modification, last consultation and last document. A
consultation that nothing answers times out by the watermark alone, without a
new document of its project.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from cumload.operators.resolve import DECIDING

STATE = "ends_at long, ends_id long, ends string, mod_at long, mod_id long, mod string, open_at long, open_id long, due long, last_at long, last_id long, shown string, shown_id long"
FIELDS = [part.split()[0] for part in STATE.split(", ")]
OUTPUT = "project long, status string, document_id long"


def due_day(published: Column, months: int) -> Column:
    """The first day on which ``months`` whole months have passed (T30): a day that the month lacks counts from the next one's first."""
    day = published.cast("date")
    there = F.add_months(day, months)
    return F.when(F.day(there) < F.day(day), F.date_add(there, 1)).otherwise(there)


class Statuses(StatefulProcessor):
    """Folds a project's notices in any order; emits its status whenever that or the document that says so changes."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.facts = handle.getValueState("facts", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        s = self._read()
        for batch in rows:
            for at, number, kind, says, due in batch[["at", "id", "kind", "says", "due"]].itertuples(index=False, name=None):
                at, number = int(at), int(number)
                if s["last_at"] is None or (at, number) > (s["last_at"], s["last_id"]):
                    s["last_at"], s["last_id"] = at, number
                if kind == "ends" and (s["ends_at"] is None or (at, number) > (s["ends_at"], s["ends_id"])):
                    s["ends_at"], s["ends_id"], s["ends"] = at, number, says
                if kind == "mod" and (s["mod_at"] is None or (at, number) < (s["mod_at"], s["mod_id"])):
                    s["mod_at"], s["mod_id"], s["mod"] = at, number, says
                if kind == "open" and (s["open_at"] is None or (at, number) > (s["open_at"], s["open_id"])):
                    s["open_at"], s["open_id"], s["due"] = at, number, int(due)
        yield from self._show(key, s, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._show(key, self._read(), timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass

    def _read(self) -> dict:
        held = self.facts.get() if self.facts.exists() else (None,) * len(FIELDS)
        return dict(zip(FIELDS, held, strict=True))

    def _show(self, key, s: dict, watermark: int) -> Iterator[pd.DataFrame]:
        if s["ends"] is not None:
            status, said = s["ends"], s["ends_id"]
        elif s["mod"] is not None:
            status, said = s["mod"], s["mod_id"]
        elif s["open_at"] is not None:
            status, said = "sin_resolucion" if s["due"] <= watermark else "en_consulta", s["open_id"]
        else:
            status, said = "desconocido", s["last_id"]
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if status == "en_consulta":
            self.handle.registerTimer(s["due"])
        changed = (status, said) != (s["shown"], s["shown_id"])
        self.facts.update(tuple((s | {"shown": status, "shown_id": said})[f] for f in FIELDS))
        if changed:
            yield pd.DataFrame({"project": [key[0]], "status": [status], "document_id": [said]})


def timed_statuses(notices: DataFrame, delay: str = "14 days", stale_months: int = 24) -> DataFrame:
    """project, status, document_id of each change, from a stream of notices: project, id, published (timestamp), doc_type, verdict.

    Days that are read again within ``delay`` change nothing, as every fold takes a notice once or twice alike; later rows
    than that are dropped with the watermark. Rows without a project or a day are left out. The session's state store
    must be the RocksDB one, which holds timers.
    """
    provider = notices.sparkSession.conf.get("spark.sql.streaming.stateStore.providerClass", "")
    if not provider.endswith("RocksDBStateStoreProvider"):
        raise ValueError("set spark.sql.streaming.stateStore.providerClass to the RocksDB provider")
    kind, granted = F.col("doc_type"), F.coalesce(F.col("verdict") != "no_aplica", F.lit(False))
    read = F.when((kind == "caducidad") | (kind.isin(*DECIDING) & granted), "ends").when((kind == "modificacion") & granted, "mod").when(kind == "informacion_publica", "open")
    due = F.unix_millis(due_day(F.col("published"), stale_months).cast("timestamp"))
    rows = notices.where("project IS NOT NULL AND id IS NOT NULL AND published IS NOT NULL").withWatermark("published", delay)
    told = rows.select(F.col("project").cast("long"), F.col("id").cast("long"), "published", F.unix_millis(F.col("published").cast("date").cast("timestamp")).alias("at"), F.coalesce(read, F.lit("")).alias("kind"), F.when(kind == "caducidad", "caducado").otherwise(F.col("verdict")).alias("says"), due.alias("due"))
    return told.groupBy("project").transformWithStateInPandas(statefulProcessor=Statuses(), outputStructType=OUTPUT, outputMode="Update", timeMode="EventTime")
