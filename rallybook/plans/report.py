"""What a run has met in its sources: rows read, values that could not be read, ids listed twice."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession

from rallybook.operators.names import repeated_ids

READ, UNREAD, REPEATED = "read", "unread", "repeated"


def run_report(spark: SparkSession, seen: dict[str, Observation], players: DataFrame) -> DataFrame:
    """`table`, `finding`, `column` and `rows`. The counts were observed while the tables were written; a
    column without unread values has its row too. An id counts as repeated once, however often it is listed."""
    found = []
    for table, observation in seen.items():
        counts = observation.get
        found.append((table, READ, None, counts.get("rows", 0)))
        found += [(table, UNREAD, column, n) for column, n in counts.items() if column != "rows"]
    found.append(("players", REPEATED, "player_id", repeated_ids(players).count()))
    return spark.createDataFrame(found, "table string, finding string, column string, rows long")
