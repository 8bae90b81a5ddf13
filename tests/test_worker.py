"""Tables that stay in a worker."""

from panelcast.worker import WorkerCache


def test_a_store_replaces_the_tables_of_other_stores():
    one, two = WorkerCache("test one", keep=2), WorkerCache("test two", keep=2)
    one.put("a", [1])
    assert one.get("a", list) == [1]
    two.put("b", [2])
    assert one.peek("a") is None and two.peek("b") == [2]
    two.put("c", [3])
    two.put("d", [4])
    assert [two.peek(k) for k in "bcd"] == [None, [3], [4]]
