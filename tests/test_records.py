"""Records of one file read by many tasks, against the plain readers."""

import gzip
import json
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from urlwarden.functions.vocab import FEATURE_NAMES
from urlwarden.sources import readers, records, writers


@pytest.fixture()
def small_ranges(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def cell(rng):
    return rng.choice(["", "plain", 'a "quoted" word', "two\nlines", "cr\r\nlf", 'ends with "', "a,b", '"', "\n", 'mid"quote', "é日本", "x" * 90, "\n\n,\"\n"])


def quoted(text, rng):
    if any(c in text for c in ',"\n\r') or rng.random() < 0.2:
        return '"' + text.replace('"', '""') + '"'
    return text


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_csv_in_ranges(spark, tmp_path, small_ranges, newline):
    rng = random.Random(newline)
    rows = [[f"u{k}", cell(rng), cell(rng), str(k)] for k in range(400)]
    text = newline.join(["url,first,second,n"] + [",".join(quoted(c, rng) for c in row) for row in rows]) + newline
    (tmp_path / "a.csv").write_bytes(text.encode())
    found = records.pieces(spark, str(tmp_path / "a.csv"), "\n")
    assert found.select("start").distinct().count() > 20
    got = {r["n"]: r for r in records.read_csv(spark, str(tmp_path / "a.csv")).collect()}
    assert len(got) == 400
    for url, first, second, n in rows:
        assert (got[n]["url"], got[n]["first"] or "", got[n]["second"] or "") == (url, first, second)
    assert records.csv_records(spark, str(tmp_path / "a.csv")).select("record").distinct().count() == 401


def test_one_cell_over_many_ranges(spark, tmp_path, small_ranges):
    text = 'a,b\n1,"' + "line, with \"\"marks\"\"\n" * 300 + '"\n2,x\n3,"y\n"\n'
    (tmp_path / "a.csv").write_text(text)
    got = sorted(tuple(r) for r in records.read_csv(spark, str(tmp_path / "a.csv")).collect())
    assert got == [("1", 'line, with "marks"\n' * 300), ("2", "x"), ("3", "y\n")]


@pytest.mark.parametrize("indent", [None, 1])
def test_json_arrays_in_ranges(spark, tmp_path, small_ranges, indent):
    rng = random.Random(indent)
    odd = ["", "}", "{", "]}[{", '"', "\\", "\\\"}", "a,b", "line\nbreak", "é日本", "x" * 200, "\\\\", "}\\"]
    rows = [{"url": f"u{k}", "label": rng.choice([0, 1, None]), "note": rng.choice(odd) + rng.choice(odd), "in": {"deep": [1, {"x": "}"}]}} for k in range(300)]
    (tmp_path / "a.json").write_text(json.dumps(rows, indent=indent, ensure_ascii=False))
    (tmp_path / "b.json").write_text("\n".join(json.dumps(r) for r in rows[:50]))
    assert records.pieces(spark, str(tmp_path / "a.json"), "}").select("start").distinct().count() > 20
    got = {r["url"]: r for r in records.read_json(spark, str(tmp_path / "a.json")).collect()}
    assert len(got) == 300
    for row in rows:
        mine = got[row["url"]]
        assert mine["note"] == row["note"] and mine["label"] == (None if row["label"] is None else str(row["label"]))
        assert json.loads(mine["in"]) == row["in"]
    assert records.read_json(spark, str(tmp_path / "b.json")).count() == 50
    assert records.read_json(spark, str(tmp_path), ["url", "gone"]).where("url IS NOT NULL AND gone IS NULL").count() == 350


def test_json_list_of_texts_in_ranges(spark, tmp_path, small_ranges):
    names = [f"domain{k}.example.com" for k in range(500)] + ["a,b", 'say "x"', "back\\slash", "tail\\", "]", "[", " "]
    (tmp_path / "a.json").write_text(json.dumps(names, indent=1))
    (tmp_path / "b.json").write_text("[]")
    (tmp_path / "c.json").write_text(json.dumps(names[-7:]))
    assert sorted(r["value"] for r in records.json_strings(spark, str(tmp_path / "a.json")).collect()) == sorted(names)
    assert sorted(r["value"] for r in records.json_strings(spark, str(tmp_path / "c.json")).collect()) == sorted(names[-7:])
    assert records.json_strings(spark, str(tmp_path / "b.json")).count() == 0
    assert readers.read_safe_domains(spark, str(tmp_path / "a.json")).count() == len(names)


def test_labelled_tables_in_ranges(spark, tmp_path, small_ranges):
    rng = random.Random(4)
    rows = [[f"u{k}", rng.choice(["bad", "NA", "", "good", "a\nb"])] for k in range(300)]
    (tmp_path / "a.csv").write_text("\n".join(["url,label"] + [",".join(quoted(c, rng) for c in row) for row in rows]))
    whole = readers.read_labelled(spark, str(tmp_path / "a.csv"))
    split = readers.read_labelled(spark, str(tmp_path / "a.csv"), in_ranges=True)
    assert sorted(map(tuple, split.fillna("-").collect())) == sorted(map(tuple, whole.fillna("-").collect()))
    (tmp_path / "a.json").write_text(json.dumps([{"url": u, "label": y or None} for u, y in rows]))
    whole = readers.read_labelled(spark, str(tmp_path / "a.json"))
    split = readers.read_labelled(spark, str(tmp_path / "a.json"), in_ranges=True)
    assert sorted(map(tuple, split.fillna("-").select("url", "label").collect())) == sorted(map(tuple, whole.fillna("-").select("url", "label").collect()))


def test_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    assert records.read_csv(spark, str(tmp_path / "a.csv")).count() == 0
    (tmp_path / "b.csv").write_text("x,y\n")
    assert records.read_csv(spark, str(tmp_path / "b.csv")).columns == ["x", "y"]
    (tmp_path / "a.json").write_text("[]")
    assert records.json_objects(spark, str(tmp_path / "a.json")).count() == 0
    assert records.json_objects(spark, str(tmp_path / "a.json")).select(F.max("record")).first()[0] is None


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_files_that_cannot_be_cut_are_read_once(spark, tmp_path, small_ranges, newline):
    rng = random.Random(newline)
    rows = [[f"u{k}", cell(rng), cell(rng), str(k)] for k in range(300)]
    for kind, folder in ((gzip.open, tmp_path / "odd %41 names"), (open, tmp_path / "plain")):
        folder.mkdir()
        for k in range(4):
            text = newline.join(["url,first,second,n"] * (k < 3) + [",".join(quoted(c, rng) for c in row) for row in rows[k * 100:][:100]]) + newline * (k < 3)
            with kind(folder / f"b {k}.csv{'.gz' if kind is gzip.open else ''}", "wb") as f:
                f.write((text + 'open,"end' * (k == 1)).encode())
        with kind(folder / f"a.csv{'.gz' if kind is gzip.open else ''}", "wb") as f:
            f.write(b"")
    uncut = records.csv_records(spark, str(tmp_path / "odd %41 names"))
    assert "stored-" not in " ".join(uncut.inputFiles()) and "Exchange" not in uncut._jdf.queryExecution().toString()
    assert records._first_record(spark, str(tmp_path / "odd %41 names"), uncut) == "url,first,second,n"
    found, plain = (sorted(map(tuple, records.read_csv(spark, path).fillna("-").collect()))
                    for path in (str(tmp_path / "odd %41 names"), str(tmp_path / "plain")))
    assert found == plain and {r[0] for r in found} == {r[0] for r in rows} | {"open"}
    (tmp_path / "none").mkdir()
    with gzip.open(tmp_path / "none" / "a.csv.gz", "wb") as f:
        f.write(b"")
    assert records.read_csv(spark, str(tmp_path / "none")).count() == 0


def test_predictions_take_little_disk(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(writers, "FILE_ROWS", 300)
    values = [F.when(F.col("id") % (k + 2) == 0, F.col("id") * 7 % 101).otherwise(0).alias(name) for k, name in enumerate(FEATURE_NAMES)]
    rows = spark.range(0, 2000, 1, 4).select(
        F.concat(F.lit('http://x\n"'), "id", F.lit(',\r\n/a')).alias("url"), F.lit(1).alias("prediction"), F.struct(*values).alias("features"))
    path = writers.write_predictions(rows, str(tmp_path), datetime(2026, 1, 1))
    files = list((tmp_path / "results_20260101_000000.csv").glob("part-*"))
    text = rows.agg(F.sum(F.octet_length(F.to_json("features")))).first()[0]
    assert len(files) == 8 and sum(f.stat().st_size for f in files) < text / 5
    assert records._first_record(spark, path, None) == "url,prediction,features"  # one file tells the names
    back = records.read_csv(spark, path)
    wanted = rows.select("url", F.col("prediction").cast("string"), F.to_json("features"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, wanted.collect()))
    plain = writers.write_predictions(rows, str(tmp_path), datetime(2026, 1, 2), compression="none")
    assert sorted(map(tuple, records.read_csv(spark, plain).collect())) == sorted(map(tuple, wanted.collect()))
