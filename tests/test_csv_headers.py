"""CSV folders with one and with several headers."""

import pytest

from tidemark.sources.feeds import csv_headers, read_csv_feed, read_csv_feeds


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "a.csv").write_text('symbol,name,price_usd\nAAB,"say ""hm"", please",1\n')
    (tmp_path / "b.csv").write_text("price_usd,symbol,name\n7,BBC,Beeb\n")
    (tmp_path / "c.csv").write_text("symbol,name,price_usd\nCCD,See,3\nDDE,Dee,4\n")
    return str(tmp_path)


def test_each_header_is_read_with_its_own_columns(spark, folder):
    assert [len(f) for f in csv_headers(spark, folder).values()] == [2, 1]
    rows = [r for f in read_csv_feeds(spark, folder) for r in f.select("symbol", "name", "price_usd").collect()]
    assert sorted(map(tuple, rows)) == [
        ("AAB", 'say "hm", please', "1"), ("BBC", "Beeb", "7"), ("CCD", "See", "3"), ("DDE", "Dee", "4")]


def test_a_differing_header_is_an_error_not_a_shift(spark, folder):
    with pytest.raises(Exception, match="header"):
        read_csv_feed(spark, folder).select("symbol", "name", "price_usd").collect()
