import json

from starloom.plans.dimensions import CUSTOMER
from starloom.plans.load import read_warehouse
from starloom.sources.schemas import struct
from starloom.sources.store import WarehouseStore
from starloom.streaming.dimension_feed import merge_feed

SCHEMA = struct("customer_id string, company_name string, country string, seq int")


def test_feed_versions_a_customer(spark, tmp_path):
    inbox, store = tmp_path / "inbox", WarehouseStore(spark, str(tmp_path / "dw"))
    inbox.mkdir()

    def deliver(name, rows):
        (inbox / name).write_text("\n".join(json.dumps(dict(zip(SCHEMA.names, r))) for r in rows))
        stream = spark.readStream.schema(SCHEMA).json(str(inbox))
        merge_feed(stream, store, CUSTOMER, "seq", str(tmp_path / "checkpoint")).awaitTermination()

    deliver("a.json", [("AAAAA", "Alpha", "UK", 1), ("BBBBB", "Beta", "UK", 1), ("AAAAA", "Alpha plc", "UK", 2)])
    deliver("b.json", [("AAAAA", "Alpha plc", "France", 3)])
    rows = read_warehouse(store)["dim_customer"].filter("customer_key <> -1").orderBy("customer_id", "valid_from").collect()
    assert [(r.customer_id, r.company_name, r.country, r.is_current) for r in rows] == [
        ("AAAAA", "Alpha plc", "UK", False), ("AAAAA", "Alpha plc", "France", True), ("BBBBB", "Beta", "UK", True)]
    assert rows[0].valid_to == rows[1].valid_from
