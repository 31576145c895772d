"""Files that land later are loaded by the stream; replays only skip."""

from helpers import ORDERS, Delivery, config, entry

from tidemark.plans.store import Store
from tidemark.streaming.landing import load_stream


def test_arrivals_are_loaded_once(spark, tmp_path):
    d = Delivery(tmp_path / "d").tenant(config("acme", sources={"orders": {"columnAliases": {}}}))
    d.listed(*[entry("acme", "orders", b, "2026-03-01", "2026-03-02") for b in (1, 2)])
    d.file("acme/orders/batch_01.csv", f"{ORDERS}\no-1,2026-03-01,fb,1.00,USD,x\n")
    store = Store(spark, str(tmp_path / "store"))

    def drain(checkpoint):
        load_stream(spark, store, d.root, str(tmp_path / checkpoint)).awaitTermination()
        return sorted((r.batch_no, r.status) for r in store.read("ledger").collect())

    assert drain("c1") == [(1, "loaded")]
    d.file("acme/orders/batch_02.csv", f"{ORDERS}\no-2,2026-03-01,fb,1.00,USD,x\n")
    assert drain("c1") == [(1, "loaded"), (2, "loaded")]
    # A lost checkpoint replays everything; the ledger keeps it from loading twice.
    assert drain("c2") == [(1, "loaded"), (2, "loaded")]
    assert store.read("raw").count() == 2
