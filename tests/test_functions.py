"""Hand-traced cases of the scalar operators."""

import datetime as dt
import random
import re
from itertools import product
from pathlib import PurePosixPath

import pytest
from pyspark.sql import functions as F

from tidegauge.functions import paths, text, times, values as vals


@pytest.mark.parametrize(
    "name, expected",
    [
        ("a.csv", ".csv"),
        ("a.tar.gz", ".gz"),
        ("a.csv.lock", ".csv"),
        ("a.lock", ""),
        (".hidden", ""),
        ("noext", ""),
        ("a.", ""),
        (".lock", ""),
        (".csv.lock", ""),
        ("a..lock", "."),
    ],
)
def test_file_type(values, name, expected):
    assert values([(name,)], "name string", paths.file_type("name")) == [expected]


def test_file_type_equals_path_suffix(values):
    names = ["".join(p) for n in range(1, 8) for p in product("a.", repeat=n)]
    names = [n for n in names if n not in (".", "..")]
    found = values([(n,) for n in names], "name string", paths.file_type("name"))
    assert found == [PurePosixPath(n).suffix for n in names]


def test_lock_files_look_through_to_the_suffix_before(values):
    stems = ["".join(p) for n in range(1, 6) for p in product("a.", repeat=n)]
    names = [s + ".lock" for s in stems]

    def expected(name):
        if PurePosixPath(name).suffix != ".lock":
            return PurePosixPath(name).suffix
        suffixes = PurePosixPath(name).suffixes
        return suffixes[-2] if len(suffixes) > 1 else ""

    found = values([(n,) for n in names], "name string", paths.file_type("name"))
    assert found == [expected(n) for n in names]


@pytest.mark.parametrize(
    "modality, protected, raw, name, expected",
    [
        ("surveys", True, True, "x.UPENN_nda.json", '{"redcap_instance":"UPENN"}'),
        ("surveys", True, True, "x.Pronet.json", '{"redcap_instance":"MGB-Pronet"}'),
        ("surveys", True, True, "x.Prescient.json", '{"redcap_instance":"MGB-Prescient"}'),
        ("surveys", True, True, "x.csv", "{}"),
        ("surveys", True, True, "x.other.json", "{}"),
        ("surveys", True, False, "x.Pronet.json", "{}"),
        ("surveys", False, True, "x.Pronet.json", "{}"),
        ("phone", True, True, "u_sensor_1.json", '{"mindlamp_type":"sensor"}'),
        ("phone", True, True, "u_activity_1.json", '{"mindlamp_type":"activity"}'),
        ("phone", True, True, "u_sensor_activity_1.json", '{"mindlamp_type":"sensor"}'),
        ("phone", True, True, "u_sensor_1.csv", "{}"),
        ("mri", True, True, "u_sensor_1.json", "{}"),
    ],
)
def test_tags(values, modality, protected, raw, name, expected):
    tags = paths.tag_json(paths.tag_columns("name", "modality", "p", "r"))
    row = (name, modality, protected, raw)
    assert values([row], "name string, modality string, p boolean, r boolean", tags) == [expected]


def test_path_parts(values):
    parts = paths.path_parts("path")
    row = F.struct(*[column.alias(name) for name, column in parts.items()])
    inside, beside, outside = values(
        [
            ("/d/x/PROTECTED/Pro netAB/raw/S 1/phone/deep/er/f.json",),
            ("/d/x/GENERAL/PronetAB/processed/S1/notes.txt",),
            ("/d/x/other/PronetAB/raw/S1/phone/f",),
        ],
        "path string",
        row,
    )
    assert tuple(inside) == (True, "Pro netAB", True, "S 1", "phone")
    assert tuple(beside) == (None,) * 5
    assert tuple(outside) == (None,) * 5


def test_network_texts(values):
    rows = [("PRO net",), ("pronet",), ("prescient",), ("X",)]
    assert values(rows, "n string", text.sentence_case("n")) == ["Pro net", "Pronet", "Prescient", "X"]
    normal = values(rows, "n string", text.normalise_network("n"))
    assert normal == ["PRO net", "ProNET", "PRESCIENT", "X"]


@pytest.mark.parametrize(
    "word, tokens",
    [
        ("camelCaseWord", ["camel", "case", "word"]),
        ("HTMLParser", ["html", "parser"]),
        ("parseURL", ["parse", "url"]),
        ("aB", ["ab"]),
        ("XY1", ["x"]),
        ("x", ["x"]),
    ],
)
def test_camel_tokens(values, word, tokens):
    capital = word[0].upper() + word[1:]
    matches = [t.lower() for t in re.findall(text.CAMEL_PATTERN, capital)]
    found = values([(word,)], "w string", text.camel_tokens("w"))[0]
    assert found == matches == tokens


def test_camel_tokens_on_random_words(values):
    rng = random.Random(3)
    words = ["".join(rng.choices("abXYZ1_é-", k=rng.randrange(1, 12))) for _ in range(2000)]
    expected = [
        [t.lower() for t in re.findall(text.CAMEL_PATTERN, w[0].upper() + w[1:])] for w in words
    ]
    assert values([(w,) for w in words], "w string", text.camel_tokens("w")) == expected


@pytest.mark.parametrize(
    "size, expected",
    [
        (0, "0 Bytes"),
        (1, "1 Byte"),
        (-1, "-1 Byte"),
        (1023, "1023 Bytes"),
        (1024, "1.0 KiB"),
        (1280, "1.2 KiB"),
        (1792, "1.8 KiB"),
        (-1536, "-1.5 KiB"),
        (1048575, "1024.0 KiB"),
        (1048576, "1.0 MiB"),
        (100 * 1024**4, "100.0 TiB"),
        (5 * 1024**5, "5.0 PiB"),
        (7 * 1024**6, "7.0 EiB"),
    ],
)
def test_binary_size(values, size, expected):
    assert values([(size,)], "b bigint", text.binary_size("b")) == [expected]


def test_binary_size_equals_c_formatting(values):
    sizes = [n * 51 + k * 256 for n in range(20, 400) for k in (0, 1, 2, 3)]
    sizes += [n * 1024 * 64 + 32768 for n in range(16, 200)]
    units = ["KiB", "MiB", "GiB"]

    def expected(size):
        if size < 1024:
            return f"{size} Bytes"
        power = next(p for p in (1, 2, 3) if size < 1024 ** (p + 1))
        return f"{size / 1024**power:.1f} {units[power - 1]}"

    found = values([(s,) for s in sizes], "b bigint", text.binary_size("b"))
    assert found == [expected(s) for s in sizes]


def test_commas(values):
    found = values([(0,), (-1234,), (1234567,)], "n bigint", text.with_commas("n"))
    assert found == ["0", "-1,234", "1,234,567"]


def test_parse_date(values):
    rows = [("2022-01-05",), ("2022-1-5",), ("2022-13-05",), ("2022-02-30",), ("22-1-5",), ("2022-01-05 ",)]
    day = dt.date(2022, 1, 5)
    assert values(rows, "t string", times.parse_date("t")) == [day, day, None, None, None, None]


def test_parse_date_equals_strptime(values):
    years = ["2022", "2024", "1999", "22", "0000", "0001", "12022", ""]
    months = [*map(str, range(14)), "01", "09", "012", "x"]
    days = [*map(str, range(33)), "05", "029", "", "1 "]
    texts = [f"{y}-{m}-{d}" for y in years for m in months for d in days]
    texts += ["2022-01-05\n", "2022/01/05", "2022-01", "20220105", "-2022-01-05", "2022-01-05T00:00:00"]

    def expected(t):
        try:
            return dt.datetime.strptime(t, "%Y-%m-%d").date()
        except ValueError:
            return None

    found = values([(t,) for t in texts], "t string", times.parse_date("t"))
    assert [(t, f) for t, f in zip(texts, found)] == [(t, expected(t)) for t in texts]


def test_times_do_not_depend_on_the_session_zone(spark, values):
    zone = spark.conf.get("spark.sql.session.timeZone")
    moment = dt.datetime(2024, 3, 31, 1, 2, 3, 500000)
    micros = int((moment - dt.datetime(1970, 1, 1)).total_seconds() * 1_000_000)
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert values([(micros,)], "m bigint", times.from_epoch_micros("m")) == [moment]
        assert values([(moment,)], "t timestamp_ntz", times.seconds_of_day("t")) == [3723.5]
        token = values([(moment,)], "t timestamp_ntz", times.date_token("t"))
        assert token == [f"<!date^{micros // 1_000_000}^{{date_short}} {{time}}|2024-03-31 01:02:03 UTC>"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_axis_labels(values):
    labels = times.axis_labels("a", "b", "n")
    rows = [(0.0, 60.0, 3), (0.0, 60.0, 1), (30.0, 90.0, 2)]
    found = values(rows, "a double, b double, n int", labels)
    assert found == [["00:00", "00:30", "01:00"], ["00:00"], ["00:30", "01:30"]]


def test_weekend_band(values):
    band = times.weekend_band("d")
    rows = [(dt.date(2024, 1, 6),), (dt.date(2024, 1, 7),)]
    found = values(rows, "d date", F.struct(band.start, band.end, band.label_at))
    assert tuple(found[0]) == (
        dt.datetime(2024, 1, 5, 12),
        dt.datetime(2024, 1, 7, 12),
        dt.datetime(2024, 1, 6, 12),
    )
    assert tuple(found[1]) == (None, None, None)


def test_date_texts(values):
    rows = [(dt.date(2024, 8, 20),)]
    assert values(rows, "d date", times.long_date("d")) == ["August 20, 2024"]
    assert values(rows, "d date", times.short_date("d")) == ["Aug 20"]


def test_flags_and_json(values):
    flags = values([("1",), ("0",), ("0.0",), ("-2",), ("yes",), (None,)], "t string", vals.nonzero_flag("t"))
    assert flags == [True, False, False, True, None, None]
    packed = vals.pack_json(["a", "b c"], {"a": "double"})
    rows = [("1", "x"), ("NaN", None), (None, 'say "NaN"')]
    found = values(rows, "a string, `b c` string", packed)
    assert found == ['{"a":1.0,"b c":"x"}', "{}", '{"b c":"say \\"NaN\\""}']
    tagged = values([('{"k":"MGB-Pronet"}',), ("{}",), (None,)], "j string", vals.tag_contains("j", "k", "MGB"))
    assert tagged == [True, None, None]


def test_sentinels(values):
    rows = [("",), ("NULL",), ("The NULL",), ("DE",)]
    assert values(rows, "t string", text.null_if_any("t", ("", "NULL"))) == [None, None, "The NULL", "DE"]


def test_hashes(values):
    assert values([("a",)], "t string", vals.content_hash("t")) == ["0cc175b9c0f1b6a831c399e269772661"]
    with pytest.raises(ValueError):
        vals.content_hash("t", "crc")


def test_sizes(values):
    assert values([(1048576,)], "b bigint", vals.bytes_to_mb("b")) == [1.0]
    assert values([(0.5,)], "m double", vals.mb_to_bytes("m")) == [524288]
