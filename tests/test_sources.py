from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

import pytest

from ordermill.sources import read_fx_documents, read_order_pages

LINE = {
    "order_id": "ORD1",
    "customer_id": 7,
    "customer_email": "c7@shop.example",
    "order_ts": "2026-01-12T10:58:06",
    "status": "completed",
    "channel": "web",
    "sku": "SKU-EL-001",
    "product_name": 'Say "hi", ünï',
    "category": None,
    "qty": 2,
    "unit_price": 1.23455,
    "currency": "EUR",
    "country": "RO",
    "fx_reference_date": "2026-08-24",
}


def write(folder, name, content):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(content if isinstance(content, str) else json.dumps(content), encoding="utf-8")


def test_pages_in_source_order_whatever_the_file_order(spark, tmp_path):
    write(tmp_path, "offset=1000.json", [{"order_id": "d"}])
    write(tmp_path, "offset=0.json", json.dumps([dict(LINE, order_id="a"), dict(LINE, order_id="b", order_ts=1781474381)], indent=1))
    write(tmp_path, "more/offset=2000/part-7.json", [])
    found = read_order_pages(spark, str(tmp_path)).orderBy("src_ord").collect()
    assert [(row.src_ord, row.order_id) for row in found] == [(0, "a"), (1, "b"), (1000, "d")]
    assert found[0].unit_price == Decimal("1.2346")
    assert found[0].product_name == 'Say "hi", ünï'
    assert found[0].fx_reference_date == dt.date(2026, 8, 24)
    assert found[1].order_ts == "1781474381"
    assert set(found[2].asDict().values()) == {1000, "d", None}


@pytest.mark.parametrize(
    "name, content, message",
    [
        ("offset=0.json", {"message": "no"}, "not a JSON array"),
        ("offset=0.json", " \n", "not a JSON array"),
        ("offset=0.json", '[{"order_id": "a"}', "MALFORMED|Malformed"),
        ("offset=0.json", [dict(LINE, qty=1.5)], "MALFORMED|Malformed"),
        ("offset=0.json", [dict(LINE, fx_reference_date="soon")], "MALFORMED|Malformed"),
        ("page.json", [LINE], "no page offset"),
    ],
)
def test_bad_pages_stop_the_read(spark, tmp_path, name, content, message):
    write(tmp_path, name, content)
    with pytest.raises(Exception, match=message):
        read_order_pages(spark, str(tmp_path)).collect()


def _document(rates, **changes):
    return {"amount": 1.0, "base": "EUR", "start_date": "2026-08-21", "end_date": "2026-08-26", "rates": rates, **changes}


def test_rate_documents(spark, tmp_path):
    write(tmp_path, "a.json", json.dumps(_document({"2026-08-24": {"RON": 5.2504}, "2026-08-25": {"RON": 5.2, "HUF": 400}}), indent=2))
    write(tmp_path, "b/late.json", _document({"2026-08-25": {"RON": 5.2537}}, end_date="2026-08-27"))
    write(tmp_path, "c.json", _document({}))
    write(tmp_path, "d.json", {"amount": 1.0})
    found = read_fx_documents(spark, str(tmp_path)).orderBy("rate_date").collect()
    assert [tuple(row) for row in found] == [
        (dt.date(2026, 8, 24), "EUR", "RON", Decimal("5.250400")),
        (dt.date(2026, 8, 25), "EUR", "RON", Decimal("5.253700")),
    ]


@pytest.mark.parametrize(
    "document, message",
    [
        (_document({"2026-08-24": {"HUF": 400}}), "no RON rate on 2026-08-24"),
        (_document({"2026-08-24": {"RON": 5}}, base="USD"), "unexpected base currency USD"),
        ("{", "MALFORMED|Malformed"),
    ],
)
def test_bad_rate_documents_stop_the_read(spark, tmp_path, document, message):
    write(tmp_path, "a.json", document)
    with pytest.raises(Exception, match=message):
        read_fx_documents(spark, str(tmp_path)).collect()
