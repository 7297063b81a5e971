import unicodedata

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from brimline.functions.text import (
    expand_colspans,
    header_field,
    looks_like_data,
    normalize_text,
    tolerant_float,
    tolerant_int,
)
from brimline.functions.time import partial_timestamp, year_from_name
from brimline.schema import PANEL_COLUMNS, RAW_COLUMNS
from brimline.sources import crawl, pages, sinks

HEADER = ",".join(RAW_COLUMNS)


def write(folder, **files):
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text, encoding="utf-8")
    return str(folder)


def rows(df):
    return df.orderBy("site_id", "timestamp").toPandas()


def test_rename_and_types(spark, tmp_path):
    path = write(tmp_path, **{"2020-01": f"{HEADER}\nS1,01/01 00:00,1.0,2.0,3.0,4.0,5.0,6.0,7.0,8,9\n"})
    df = crawl.read_crawl(spark, path, label_local_as_utc=True)
    assert df.columns == PANEL_COLUMNS
    got = df.first()
    assert (got.site_id, str(got.timestamp)) == ("S1", "2020-01-01 00:00:00")
    assert [got[c] for c in PANEL_COLUMNS[2:]] == [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8, 9]
    assert dict(df.dtypes)["so_cua_xa_sau"] == "bigint"
    assert str(crawl.read_crawl(spark, path).first().timestamp) == "2019-12-31 17:00:00"


def test_missing_key_columns(spark, tmp_path):
    for n, head in enumerate(("ten_ho,x", "timestamp,x")):
        folder = tmp_path / str(n)
        folder.mkdir()
        path = write(folder, **{"2020-01": f"{head}\n01/01 00:00,1\n"})
        parsed = crawl.parse_lines(crawl.read_lines(spark, path))
        assert crawl.panel_of(parsed).count() == 0
        assert "column" in crawl.rejects_of(parsed).first().reject_reason
        with pytest.raises(PySparkException, match="column"):
            crawl.read_crawl(spark, path, strict=True).collect()


def test_bad_values_blanks_and_absent_columns(spark, tmp_path):
    path = write(tmp_path, **{"202001": "ten_ho,timestamp,muc_nuoc_thuong_luu,so_cua_xa_sau\n"
                              'S1,01/0100:00,bad,2\n"S, 2",01/01 01:00,"1.5",x\nS3,01/01 02:00\nS4,1/1 3:00,1d,1.5\n'})
    got = rows(crawl.read_crawl(spark, path, label_local_as_utc=True))
    assert list(got.site_id) == ["S, 2", "S1", "S3", "S4"]
    assert list(got.timestamp.dt.hour) == [1, 0, 2, 3]
    assert got.muc_thuong_luu.isna().tolist() == [False, True, True, True]
    assert got.so_cua_xa_sau.isna().tolist() == [True, False, True, True]
    assert (got.luu_luong_den == 0).all() and (got.so_cua_xa_mat == 0).all()


def test_keep_last_in_line_then_path_order(spark, tmp_path):
    path = write(tmp_path, **{
        "2020-01": "ten_ho,timestamp,muc_nuoc_thuong_luu\nS1,01/01 00:00,1\nS1,01/01 00:00,2\nS0,01/01 00:00,7\n",
        "2020_01_data": "muc_nuoc_thuong_luu,timestamp,extra,ten_ho\n3,01/01 00:00,z,S1\n4,02/01 00:00,z,S1\n",
    })
    got = rows(crawl.read_crawl(spark, path))
    assert got.muc_thuong_luu.tolist() == [7, 3, 4]


def test_rejects(spark, tmp_path):
    long = ",".join(["S1", "01/01 05:00", *["1"] * 10])
    path = write(tmp_path, **{"2023-02": f"{HEADER}\n{long}\nS1,29/02 00:00,1\nS1,28/02 00:00,1\n"
                              f"2023-02-01 00:00,500,\"{crawl.FAILURE_MARK}}}\",none\n\n",
                              "nodate": f"{HEADER}\nS1,01/01 00:00,1\n"})
    parsed = crawl.parse_lines(crawl.read_lines(spark, path))
    reasons = sorted(r.reject_reason for r in crawl.rejects_of(parsed).collect())
    assert reasons == ["bad timestamp", "failure row", "no year in file name", "too many fields"]
    assert crawl.panel_of(parsed).count() == 1


def test_no_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        crawl.read_crawl(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        crawl.read_crawl(spark, [])


def test_year_rollover(spark, tmp_path):
    path = write(tmp_path, **{"2024-01": "ten_ho,timestamp\nS1,31/12 23:00\nS1,01/01 00:00\n"})
    got = rows(crawl.read_crawl(spark, path, label_local_as_utc=True, year_rollover=True))
    assert got.timestamp.dt.year.tolist() == [2023, 2024]


def test_years_and_partial_times(spark):
    names = ["202001.csv", "2020-01.csv", "2020_01_data.csv", "x2021.csv", "none.csv"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(year_from_name(F.col("n"))).collect()] == [2020, 2020, 2020, 2021, None]
    stamps = {"1/1 00:00": "01-01 00:00", "1/100:00": "10-01 00:00", "29/02 10:05": "02-29 10:05",
              " 05/0607:08 ": "06-05 07:08", "31/04 00:00": None, "24:00": None, "": None}
    df = spark.createDataFrame([(s,) for s in stamps], "s string")
    got = df.select(F.date_format(partial_timestamp(F.col("s"), F.lit(2024)), "MM-dd HH:mm")).collect()
    assert [r[0] for r in got] == list(stamps.values())


PAGE = """<html><table><tr><td>menu</td></tr></table><table class="x tblgridtd">
<tr><th>Tên hồ</th><th>Thời điểm</th>{filler}</tr><tr><td colspan="11"><strong>Tây Nguyên</strong></td></tr>
<tr><td class=""><b>Đồng Nai 3</b><br /><small>Đồng bộ lúc: 17:30 06/11</small></td><td> 06/11 12:00 </td>
<td>1,589.79</td><td>590</td><td>570</td><td>271.26</td><td></td><td>37</td><td>n/a</td><td>x</td><td>1.9</td></tr>
<tr><td>Hồ B<script>no()</script></td><td>06/11 12:00</td>{nine}</tr><tr><td>few</td></tr></table></html>"""


def test_page_extraction(spark):
    html = PAGE.format(filler="<th>1</th>" * 9, nine="<td>-</td>" * 9)
    plain = "<tbody><tr><td>S&amp;T</td><td>01/01 00:00" + "<td>1</td>" * 9 + "</tr></tbody>"
    df = spark.createDataFrame([(1, html), (2, "<p>nothing</p>"), (3, None), (4, plain)], "page_id int, html string")
    got = pages.records(pages.extract_rows(df)).collect()
    r, swallowed = sorted(got, key=lambda r: r.page_id)
    # An unclosed cell holds the cells after it, so its text is theirs as well.
    assert (swallowed.ten_ho, swallowed.timestamp) == ("S&T", "01/01 00:00" + "1" * 9)
    assert (r.page_id, r.ten_ho, r.timestamp) == (1, "Đồng Nai 3", "06/11 12:00")
    assert [r[c] for c in RAW_COLUMNS[2:]] == [1589.79, 590.0, 570.0, 271.26, None, 37.0, None, 0, 1]


def test_text_functions(spark):
    words = ["Tên hồ", "Thời điểm", " Chú thích, ký hiệu ", "ĐÈN", "ﬁne ½ m³", "日本 ①", None, "a b…"]
    df = spark.createDataFrame([(w,) for w in words], "w string")

    def plain(s):
        s = "".join(c for c in unicodedata.normalize("NFKD", s or "") if not unicodedata.combining(c))
        return "".join(c for c in s if c.isalnum() or c.isspace()).lower().strip()

    assert [r[0] for r in df.select(normalize_text(F.col("w"))).collect()] == [plain(w) for w in words]
    headers = {"Tên hồ": "ten_ho", "Ngày giờ": "timestamp", "Mực nước thượng lưu (m)": "muc_nuoc_thuong_luu",
               "Mực nước dâng bình thường": "timestamp", "Mực nước chết": "muc_nuoc_chet",
               "Lưu lượng đến hồ": None, "Tổng lượng xả": "tong_luong_xa",
               "Tổng lượng xả qua nhà máy": "tong_luong_xa_qua_nha_may", "Số cửa xả sâu": "so_cua_xa_sau",
               "Số cửa xả mặt": "so_cua_xa_mat", "other": None}
    headers["Mực nước dâng bình thường"] = "muc_nuoc_thuong_luu"  # "thuong" is asked for first
    df = spark.createDataFrame([(h,) for h in headers], "h string")
    assert [r[0] for r in df.select(header_field(F.col("h"))).collect()] == list(headers.values())
    numbers = {" 1,234.5 ": (1234.5, 1234), "-7.9": (-7.9, -7), "": (None, None), "1d": (None, None),
               "nan": (None, None), "inf": (float("inf"), None), "1e3": (1000.0, 1000)}
    df = spark.createDataFrame([(n,) for n in numbers], "n string")
    got = df.select(tolerant_float(F.col("n")), tolerant_int(F.col("n"))).collect()
    assert [tuple(r) for r in got] == list(numbers.values())


def test_table_helpers(spark):
    df = spark.sql("select array(named_struct('text','a','colspan',2), named_struct('text','b','colspan',1)) h,"
                   " array('x','6/11/25') d, array('1','2,000','x') n, array('x','y') t")
    got = df.select(expand_colspans(F.col("h")), looks_like_data(F.col("d"), 11), looks_like_data(F.col("n"), 8),
                    looks_like_data(F.col("n"), 11), looks_like_data(F.col("t"), 2)).first()
    assert list(got) == [["a", "a", "b"], True, True, False, False]


def test_panel_csv(spark, tmp_path):
    path = write(tmp_path, p="timestamp,muc_thuong_luu,note\n2024-01-01T00:00:00Z,1.5,x\nbad,2,y\n")
    got = crawl.read_panel(spark, path).orderBy("note").collect()
    assert {r.site_id for r in got} == {"SITE_001"} and [r.timestamp is None for r in got] == [False, True]
    assert [(r.muc_thuong_luu, r.note) for r in got] == [(1.5, "x"), (2.0, "y")]
    (tmp_path / "q").mkdir()
    with pytest.raises(ValueError, match="timestamp"):
        crawl.read_panel(spark, write(tmp_path / "q", x="a\n1\n"))


def test_failure_rows(spark):
    polls = spark.createDataFrame(pd.DataFrame({
        "page_id": [1, 2, 3], "poll_time": pd.Timestamp("2024-05-06 07:08"), "status_code": 500,
        "params": "p", "content": ["a\nb ", "x" * 6000, "ok"]}))
    records = spark.createDataFrame([(3,)], "page_id bigint")
    got = sinks.failure_rows(polls, records).orderBy("content").collect()
    assert [r.content for r in got] == ["a b", "x" * 5000 + "…"]
    assert got[0].timestamp == "2024-05-06 07:08" and got[0].month == "2024-05"
