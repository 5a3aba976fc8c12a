"""CSV ingestion keeps COPY's NULL / empty-string / quoting rules and aborts on a bad row."""

import os
import random
import tempfile

import pytest

from orderlens.sources.csv import ingest, read_csv


def _write(text: str) -> str:
    folder = tempfile.mkdtemp(prefix="orderlens-csv-")
    path = os.path.join(folder, "t.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


REVIEWS = (
    "review_id,order_id,review_score,review_comment_title,review_comment_message,"
    "review_creation_date,review_answer_timestamp\n"
    'r1,o1,5,,"",2018-01-18 00:00:00,2018-01-18 21:46:59\n'
    'r2,o2,,"say ""hi""","line one\nline two",,\n'
)


def test_null_empty_quotes_newlines(spark):
    rows = {r["review_id"]: r for r in read_csv(spark, _write(REVIEWS), "order_reviews").collect()}
    assert rows["r1"]["review_comment_title"] is None      # unquoted empty -> NULL
    assert rows["r1"]["review_comment_message"] == ""      # quoted empty -> ''
    assert rows["r1"]["review_score"] == 5
    assert str(rows["r1"]["review_answer_timestamp"]) == "2018-01-18 21:46:59"
    assert rows["r2"]["review_comment_title"] == 'say "hi"'
    assert rows["r2"]["review_comment_message"] == "line one\nline two"
    assert rows["r2"]["review_score"] is None and rows["r2"]["review_creation_date"] is None


def test_bad_number_aborts(spark):
    text = "order_id,payment_sequential,payment_type,payment_installments,payment_value\no1,x,boleto,1,10.00\n"
    with pytest.raises(Exception):
        read_csv(spark, _write(text), "order_payments").collect()


def test_ingest_writes_all_columns(spark):
    text = "order_id,payment_sequential,payment_type,payment_installments,payment_value\no1,1,boleto,2,10.50\n"
    out = tempfile.mkdtemp(prefix="orderlens-raw-")
    written = ingest(spark, {"order_payments": _write(text)}, out)
    df = spark.read.parquet(written["order_payments"])
    assert df.columns == ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"]
    r = df.first()
    assert r["payment_installments"] == 2 and str(r["payment_value"]) == "10.50"


# --- newlines in quotes, many tasks a file ---
HEADER = REVIEWS.split("\n")[0]


def _split_small(spark, size):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    return old


def _field(rng):
    return rng.choice(["", '""', "plain", '"a, b"', '"say ""hi"""', '"line one\nline two"', '"\n\n"', '""""', '"""\n"""', '"é\r\n漢"',
                       '"' + "long text\n" * 30 + '"', '"' + '""' * 9 + '"', "it's"])


@pytest.mark.parametrize("end, size", [("\n", 64), ("\n", 1000), ("\r\n", 50), ("\n", 1 << 27)])
def test_parallel_records_equal_the_one_task_reader(spark, end, size):
    rng = random.Random(size)
    files = []
    for k in range(3):
        rows = [",".join([f"r{k}-{n}", _field(rng), str(rng.randint(1, 5)), _field(rng), _field(rng), "", "2018-01-18 21:46:59"])
                for n in range(60)]
        files.append(_write(end.join([HEADER, *rows[:30], "", *rows[30:]]) + (end if k else "")))
    old = _split_small(spark, size)
    try:
        got = read_csv(spark, files, "order_reviews")
        many = got.rdd.getNumPartitions()
        mine = sorted(map(str, got.collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want = sorted(str(r) for f in files for r in read_csv(spark, f, "order_reviews", multiline=True).collect())
    if end == "\r\n":  # Spark's reader makes every line end of such a file a newline, in quotes too; COPY, and ours, keep it
        assert any("é\\r\\n漢" in r for r in mine)
        mine = sorted(r.replace("\\r\\n", "\\n") for r in mine)
    assert len(mine) == 180 and mine == want
    assert many > 20 or size >= 1000


def test_a_record_over_many_ranges_and_a_quoted_header(spark):
    head = HEADER.replace("review_comment_title", '"review\ncomment ""title"""')
    text = "x\n" * 400
    path = _write(f'{head}\nr1,o1,5,"{text}","{text}",,\nr2,o2,1,t,m,,\n')
    old = _split_small(spark, 40)
    try:
        rows = {r["review_id"]: r for r in read_csv(spark, path, "order_reviews").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert set(rows) == {"r1", "r2"} and rows["r1"]["review_comment_message"] == text and rows["r2"]["review_score"] == 1


@pytest.mark.parametrize("text, why", [
    (f'{HEADER}\nr1,o1,5,"open,,,\n', "inside quotes"), (f"{HEADER}\rr1,o1,5,a,b,,\rr2,o1,5,a,b,,", "carriage return"),
    (f"{HEADER}\nr1,o1,five,a,b,,\n", "MALFORMED|malformed"), (f"{HEADER}\nr1,o1,5\n", "MALFORMED|malformed")])
def test_faulty_files_abort(spark, text, why):
    with pytest.raises(Exception, match=why):
        read_csv(spark, _write(text), "order_reviews").collect()


def test_a_file_without_rows(spark):
    assert read_csv(spark, _write(HEADER + "\n"), "order_reviews").count() == 0
    assert read_csv(spark, _write(""), "order_reviews").count() == 0
