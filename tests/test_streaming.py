import json

from conftest import rows

from activlake.operators.bronze import to_bronze
from activlake.operators.notify import to_notifications
from activlake.schemas import BRONZE, NOTIFICATION
from activlake.sources.cdc import read_cdc_files
from activlake.sources.tables import read_table
from activlake.streaming import start_bronze, start_notifications


def land(spark, folder, first, last):
    """Envelope files: inserts, one delete, one broken message."""
    texts = [
        json.dumps({"payload": {"op": "c", "after": {
            "id": i, "id_salarie": i % 3, "type_sport": "JUDO", "distance": 10.5 * i,
            "date_debut": 1743898597000000 + i * 86400000000,
            "date_fin": 1743899995000000 + i * 86400000000, "commentaire": f"P{i} - JUDO"}}})
        for i in range(first, last)
    ]
    texts += ['{"payload": {"after": null}}', "garbage", None]
    df = spark.createDataFrame([(t and t.encode(),) for t in texts], "value binary")
    df.coalesce(1).write.mode("append").parquet(folder)
    return df


def drain(query):
    query.awaitTermination()
    return query


def test_two_consumers_restart_and_agree_with_batch(spark, tmp_path):
    inbox = str(tmp_path / "in")
    bronze, notes = str(tmp_path / "bronze"), str(tmp_path / "notes")

    def run():
        source = lambda: read_cdc_files(spark, inbox, max_files_per_trigger=1)
        drain(start_bronze(source(), bronze, str(tmp_path / "c1"), "available"))
        drain(start_notifications(source(), notes, str(tmp_path / "c2"), "available"))
        return (
            rows(read_table(spark, bronze, BRONZE)),
            rows(read_table(spark, notes, NOTIFICATION)),
        )

    land(spark, inbox, 1, 5)
    first = run()
    assert run() == first  # a restart with no new input appends nothing
    land(spark, inbox, 5, 9)
    both = run()
    messages = spark.read.parquet(inbox)
    assert both == (rows(to_bronze(messages)), rows(to_notifications(messages)))
    assert len(both[0]) == len(both[1]) == 8


def test_bronze_by_day(spark, tmp_path):
    inbox, table = str(tmp_path / "in"), tmp_path / "bronze"
    land(spark, inbox, 1, 4)
    drain(start_bronze(read_cdc_files(spark, inbox), str(table), str(tmp_path / "c"), "available", by_day=True))
    assert len(list(table.glob("jour_debut=*"))) == 3
    assert rows(read_table(spark, str(table), BRONZE)) == rows(to_bronze(spark.read.parquet(inbox)))


def test_text_source_and_interval_trigger(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    (inbox / "a.txt").write_text(
        '{"payload": {"after": {"id": 1, "date_debut": 1, "date_fin": 2000001}}}\nnot json\n',
        encoding="utf-8",
    )
    query = start_bronze(
        read_cdc_files(spark, str(inbox), "text"), str(tmp_path / "b"), str(tmp_path / "c"), "1 second"
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert rows(read_table(spark, str(tmp_path / "b"), BRONZE), "id", "duration_sec") == [(1, 2)]


def test_identifiers_beyond_32_bits_survive(spark):
    texts = [json.dumps({"payload": {"after": {"id": i, "id_salarie": i + 1}}}) for i in (3_000_000_000, 1)]
    messages = spark.createDataFrame([(t.encode(),) for t in texts], "value binary")
    assert rows(to_bronze(messages), "id", "id_salarie") == [(1, 2), (3_000_000_000, 3_000_000_001)]
    assert rows(to_notifications(messages), "id") == [(1,), (3_000_000_000,)]


def test_dates_that_are_far_apart_do_not_stop_a_stream(spark, tmp_path):
    inbox = str(tmp_path / "in")

    def send(i, start, end):
        text = json.dumps({"payload": {"after": {"id": i, "date_debut": start, "date_fin": end}}})
        spark.createDataFrame([(text.encode(),)], "value binary").write.mode("append").parquet(inbox)

    def run():
        drain(start_notifications(read_cdc_files(spark, inbox), str(tmp_path / "n"), str(tmp_path / "c"), "available"))
        return rows(read_table(spark, str(tmp_path / "n"), NOTIFICATION), "id", "duration_min")

    send(1, str(-(2**63) + 1), str(2**63 - 1))
    assert run() == [(1, 0)]
    send(2, "60000000", "180000000")
    assert run() == [(1, 0), (2, 2)]


def test_a_backlog_writes_few_files_per_day(spark, tmp_path):
    inbox, table = str(tmp_path / "in"), tmp_path / "bronze"
    for i in range(6):
        land(spark, inbox, 1 + 3 * (i % 2), 4 + 3 * (i % 2))
    source = read_cdc_files(spark, inbox)
    drain(start_bronze(source, str(table), str(tmp_path / "c"), "available", by_day=True, files_per_day=2))
    per_day = [len(list(d.glob("*.parquet"))) for d in table.glob("jour_debut=*")]
    assert len(per_day) == 6 and max(per_day) <= 2
