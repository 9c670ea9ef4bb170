"""Column functions on hand-made edge values."""

import re
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from docledger.functions import messages, paths, status, timing


def values(spark, texts, *columns):
    """Each column evaluated on every text, in order."""
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [tuple(r)[1:] for r in df.select("i", *columns).orderBy("i").collect()]


def one(spark, texts, column):
    return [v[0] for v in values(spark, texts, column)]


def test_full_path_modes(spark):
    df = spark.createDataFrame([("r", "c", "f"), (None, "c", "f"), ("r", None, "f"),
                                ("r", "c", None)], "a string, b string, n string")
    shown = {mode: [r[0] for r in df.select(paths.full_path("a", "b", "n", mode)).collect()]
             for mode in ("single", "double", "unc", "skip_null")}
    assert shown["single"] == ["r\\c\\f", None, None, None]
    assert shown["double"] == ["r\\\\c\\\\f", None, None, None]
    assert shown["unc"] == ["\\\\r\\c\\f", None, None, None]
    assert shown["skip_null"] == ["r\\\\c\\\\f", "c\\\\f", "r\\\\f", "r\\\\c"]
    with pytest.raises(ValueError):
        paths.full_path("a", "b", "n", "other")


ODD_PATHS = ["", None, "\\\\srv\\share\\a b\\f.pdf", "//srv/share/f", " \t\\\\s\\h\\f\u00a0\n",
             "\\\\srv\\share", "\\\\srv\\share\\", "\\\\srv\\\\f", "\\srv\\share\\f", "C:\\x\\y",
             "\\\\srv\\share\\\\x", "plain", "/a/b", "/a/b/", "\\\\SRV\\Share\\F", "\\\\s\\h\\f\n"]


def test_normalise_path(spark):
    assert one(spark, ODD_PATHS, paths.normalise_path("t")) == [
        None if t is None else t.replace("/", "\\").strip() for t in ODD_PATHS]
    assert one(spark, ODD_PATHS, paths.normalise_path("t", strip=False)) == [
        None if t is None else t.replace("/", "\\") for t in ODD_PATHS]


def test_path_allowed(spark):
    patterns = [r"\\\\srv\\share\\[\w ]+", "", "(broken", r"c:\\x$"]
    good = [p for p in patterns if p and p != "(broken"]
    texts = ODD_PATHS + ["C:\\x", "c:\\X\n", "\\\\srv\\share\\ÄÖ", "x\\\\srv\\share\\f"]
    wanted = [t is not None and any(re.match(p, t, re.IGNORECASE) for p in good) for t in texts]
    assert one(spark, texts, paths.path_allowed("t", patterns)) == wanted
    assert one(spark, texts, paths.path_allowed("t", ["(broken"])) == [False] * len(texts)
    with pytest.raises(ValueError):
        paths.path_allowed("t", ["", "  "])


def test_parse_unc(spark):
    got = one(spark, ODD_PATHS, paths.parse_unc("t"))
    for text, parsed in zip(ODD_PATHS, got):
        match = re.match(r"^\\\\([^\\]+)\\([^\\]+)\\(.+)$", text or "")
        assert (tuple(parsed) if parsed else None) == (match.groups() if match else None), text


def test_unc_error(spark):
    def wrong(t):
        return t is None or not t.startswith("\\\\") or len(t.strip("\\").split("\\")) < 3
    assert one(spark, ODD_PATHS, paths.unc_error("t")) == [400 if wrong(t) else None for t in ODD_PATHS]


def test_base_name(spark):
    assert one(spark, ODD_PATHS, paths.base_name("t")) == [
        None if t is None else t.split("\\")[-1] if "\\" in t else t.split("/")[-1]
        for t in ODD_PATHS]


def test_route_share(spark):
    texts = ["\\\\s\\QA1\\d\\f", "\\\\s\\QA\\f", "\\\\s\\XQA\\QA\\f", "\\\\s\\other\\f", None,
             "\\\\s\\QA\\QA1\\f"]
    got = one(spark, texts, paths.route_share("t", ["QA1", "QA"]))
    assert [tuple(g) for g in got] == [
        ("QA1", "d\\f", None), ("QA", "f", None),
        ("QA", "QA\\f", None),  # what follows the first occurrence of the name
        (None, None, 400), (None, None, 400), ("QA1", "f", None)]


def test_target_key(spark):
    assert one(spark, ["f", None], paths.target_key("t", prefix="p", ar=F.lit(None).cast("string"))
               ) == ["p/default/f", None]
    with pytest.raises(ValueError):
        paths.target_key("t", "auth/file")


def test_guid_suffix(spark):
    texts = ["a-b-c-d-efgh", "a-b-c-d-efgh-ij", "a-b-c-d", None, "a-b-c-d-e"]

    def wanted(t, i):
        parts = (t or "").split("-")
        return "-".join(parts[:4] + [f"{i:02d}" + parts[4][2:]]) if len(parts) >= 5 else None
    for i in (0, 7, 99, 100, 1234):
        assert one(spark, texts, paths.guid_suffix("t", F.lit(i))) == [wanted(t, i) for t in texts]


def test_is_retryable_agrees_with_the_task_rule(spark):
    cases = [(k, c) for k in ("http", "connection", "timeout", "not_found", "other", None)
             for c in (None, 200, 404, 408, 429, 500, 501, 504)]
    df = spark.createDataFrame(cases, "kind string, code int")
    got = df.select("kind", "code", status.is_retryable("code", "kind").alias("again")).collect()
    assert all(r["again"] == status.should_retry(r["kind"], r["code"]) for r in got)
    assert status.should_retry("http", 408) and not status.should_retry("http", 501)


def test_classify(spark):
    df = spark.createDataFrame([(200, "success"), (200, "Success"), (201, "Success"), (200, None),
                                (204, "FAILED"), (404, "Success"), (None, None)],
                               "code int, status string")
    got = [tuple(r) for r in df.select(
        status.classify("code"), status.classify("code", "status", "strict"),
        status.classify("code", "status", "not_failed")).collect()]
    assert got == [(True, True, True), (True, True, True), (True, False, True), (True, False, True),
                   (True, False, False), (False, False, False), (False, False, False)]


def test_storage_error_code(spark):
    df = spark.createDataFrame([
        ("not_found", None), ("denied", None), ("bad_path", "x"), ("other", "No such file: a"),
        ("other", "STATUS_LOGON_FAILURE"), ("other", "OBJECT_NAME_NOT_FOUND"), ("other", None),
        (None, "disk full")], "kind string, m string")
    assert [r[0] for r in df.select(status.storage_error_code("kind", "m")).collect()] == [
        404, 403, 400, 404, 403, 404, 500, 500]


def test_parse_reply(spark):
    bodies = ['{"message":"m","error":"e"}', ' {"detail":{"x":1},"total_bytes":7}', "plain", "",
              '"boom"', "[1,2]", "5", "null", '{"message":null}', '{"a":1} tail', '{"cut', None,
              '{"message":"a\\\\b \\u00e4"}', "1,2"]
    got = [r.asDict() for r in one(spark, bodies, messages.parse_reply("t"))]
    assert [g["message"] for g in got] == [
        "m", None, "plain", "", "boom", None, None, None, None, '{"a":1} tail', '{"cut', None,
        "a\\b ä", "1,2"]
    assert [g["data"] for g in got[4:7]] == ["boom", "[1,2]", "5"]
    assert got[0]["error"] == "e" and got[1]["detail"] == '{"x":1}' and got[1]["total_bytes"] == "7"


def test_parse_request(spark):
    bodies = ['{"file_path":"p","ar_number":"a"}', '{"file_path":"p"}', "x", "[]", None,
              '{"file_path":"p","ar_number":"a","mime_type":"m"}', '{"file_path":"p","ar_number":""}']
    got = [tuple(r) for r in one(spark, bodies, messages.parse_request("t"))]
    assert got == [("p", "a", "application/json", None), ("p", None, "application/json", 400),
                   (None, None, "application/json", 400), (None, None, "application/json", 400),
                   (None, None, "application/json", 400), ("p", "a", "m", None),
                   ("p", "", "application/json", 400)]


def test_payload_json_keeps_null(spark):
    assert one(spark, ["a\\b", None], messages.payload_json(F.col("t").alias("file_path"))) == [
        '{"file_path":"a\\\\b"}', '{"file_path":null}']


def test_reply_target(spark):
    df = spark.createDataFrame([("u", "p", "k"), ("", "p", "k"), (None, "", "k"), (None, None, None)],
                               "u string, p string, k string")
    assert [r[0] for r in df.select(messages.reply_target("u", "p", "k")).collect()] == [
        "u", "p", "k", ""]


def test_times(spark):
    texts = ["2024-01-01 00:00:00", "2024-01-01 10:20:30.000405", "1969-12-31 23:59:59.5", None]
    at = F.col("t").cast("timestamp")

    def iso(t):
        return None if t is None else datetime.fromisoformat(t).isoformat()
    assert one(spark, texts, timing.iso_text(at)) == [iso(t) for t in texts]
    assert one(spark, texts, timing.iso_utc(at)) == [t and iso(t) + "Z" for t in texts]
    assert one(spark, ["a+00:00", "a"], timing.with_zulu("t")) == ["a+00:00", "aZ"]
    assert one(spark, texts[:1], timing.stamped_name(at)) == [
        "audit-logs/uploaded_2024-01-01T00_00_00"]


def test_elapsed_ms(spark):
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    ends = ["2024-01-01 00:00:00.0009", "2024-01-01 00:00:01.2349", "2023-12-31 23:59:59.9985"]
    assert one(spark, ends, timing.elapsed_ms(start, F.col("t").cast("timestamp"))) == [0, 1234, -1]
    assert one(spark, ends, timing.elapsed_ms(start, F.col("t").cast("timestamp"), at_least=1)
               ) == [1, 1234, 1]


def test_cast_code(spark):
    assert one(spark, ["404", "n/a", None], status.cast_code("t")) == [404, None, None]


def test_utc_default(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    got = spark.range(1).select(timing.instant("2024-02-01 00:00:00").alias("t")).first()["t"]
    assert got.replace(tzinfo=timezone.utc).timestamp() == 1706745600 or got == datetime(2024, 2, 1)
