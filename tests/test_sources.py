"""Readers and writers through files."""

import datetime
import gzip
import json

import pytest
from pyspark.sql import functions as F

from brindle.operators import boxes as ops, logs as reports
from brindle.session import materialize, shared_dir
from brindle.sources import annotations, logs, records, sinks, text

LINE = 'ix-sac6-20.ix.netcom.com - - [08/Aug/1995:14:43:39 -0400] "GET / HTTP/1.0 " 200 7131'


def lines_of(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_log_line(spark):
    row = logs.access_logs(logs.parse_log(lines_of(spark, LINE))).first()
    assert row["endpoint"] == "/" and row["protocol"] == "HTTP/1.0"
    assert row["date_time"] == datetime.datetime(1995, 8, 8, 14, 43, 39)
    assert (row["response_code"], row["content_size"]) == (200, 7131)


def test_bad_log_lines(spark):
    no_protocol = 'h - - [01/Aug/1995:00:00:01 -0400] "GET /x" 304 -'
    bad = [
        "nonsense",
        LINE.replace("08/Aug", "08/Axg"),
        LINE.replace("08/Aug", "38/Aug"),
        LINE.replace("7131", "many"),
        LINE.replace('"', ""),
        "a\nb\nc\nd\ne\nf\ng\nh\ni",
    ]
    parsed = logs.parse_log(lines_of(spark, LINE, no_protocol, *bad))
    assert tuple(logs.log_status(parsed).first()) == (8, 2, 6)
    assert {r["line"] for r in logs.failed_logs(parsed).collect()} == set(bad)
    row = logs.access_logs(parsed).where("host = 'h'").first()
    assert (row["protocol"], row["content_size"]) == ("", 0)


def test_day_key_can_keep_months_apart(spark):
    two = logs.access_logs(logs.parse_log(lines_of(spark, LINE, LINE.replace("Aug", "Sep"))))
    assert reports.daily_hosts(two).count() == 1
    assert reports.daily_hosts(two, by="date").count() == 2


def test_gzip_lines_are_spread(spark, tmp_path):
    with gzip.open(tmp_path / "r.gz", "wt") as f:
        f.write("1::2::3.5::99\n1::x::4::98\n")
    lines = text.read_lines(spark, str(tmp_path / "r.gz"), min_partitions=3)
    assert lines.rdd.getNumPartitions() == 3
    got = sorted(map(tuple, records.parse_ratings(lines).collect()), key=str)
    assert got == [(1, 2, 3.5, 99), (1, None, 4.0, 98)]


def test_titles_points_series(spark):
    title = records.parse_titles(lines_of(spark, "7::A (1995)::Drama|War")).first()
    assert tuple(title) == (7, "A (1995)", ["Drama", "War"])
    point = records.parse_points(lines_of(spark, "2001,0.5,1.25")).first()
    assert tuple(point) == (2001.0, [0.5, 1.25])
    series = records.parse_series(lines_of(spark, " 3  4 1.5 2.5 \t3")).first()
    assert tuple(series) == (3, 4, [1.5, 2.5, 3.0])


def test_words_classes_anchors(spark, tmp_path):
    (tmp_path / "stop.txt").write_text("the\nof\nthe\n\n")
    assert text.word_set(text.read_words(spark, str(tmp_path / "stop.txt"))) == ["of", "the"]
    with pytest.raises(ValueError):
        text.word_set(text.read_words(spark, str(tmp_path / "stop.txt")), max_words=1)
    (tmp_path / "classes.txt").write_text("house\nwindow\n")
    got = text.read_class_names(spark, str(tmp_path / "classes.txt")).orderBy("code").collect()
    assert list(map(tuple, got)) == [(0, "house"), (1, "window")]
    (tmp_path / "anchors.txt").write_text("10,13,  16,30,  33,23")
    got = text.read_anchors(spark, str(tmp_path / "anchors.txt")).orderBy("anchor_id").collect()
    assert list(map(tuple, got)) == [(0, 10.0, 13.0), (1, 16.0, 30.0), (2, 33.0, 23.0)]


def test_anchor_file_round_trip(spark, tmp_path):
    sinks.write_anchors(spark, [(10, 13), (16, 30)], str(tmp_path / "a"))
    assert text.read_lines(spark, str(tmp_path / "a")).first()[0] == "10,13, 16,30"
    assert text.read_anchors(spark, str(tmp_path / "a")).count() == 2


def test_class_file_round_trip(spark, tmp_path):
    codes = spark.createDataFrame([("b", 1), ("a", 2), ("c", 0)], "label string, code int")
    sinks.write_class_names(codes, str(tmp_path / "c"))
    got = text.read_class_names(spark, str(tmp_path / "c")).collect()
    assert sorted(map(tuple, got)) == [(0, "c"), (1, "b"), (2, "a")]


def test_file_list(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    for name in ("a.jpg", "b.txt", "deep/c.png"):
        (tmp_path / name).write_text("x")
    got = text.list_files(spark, str(tmp_path)).collect()
    assert sorted(r["path"].rsplit("/", 1)[1] for r in got) == ["a.jpg", "c.png"]


def test_remove_words(spark):
    from brindle.operators.linkage import remove_words

    words = spark.createDataFrame([(1, "the"), (1, "fox")], "id int, token string")
    stop = spark.createDataFrame([("the",)], "word string")
    assert [r["token"] for r in remove_words(words, stop).collect()] == ["fox"]


def asset(name, *regions):
    return {
        "asset": {"format": "jpg", "id": "0", "name": name, "path": "file:/p/" + name,
                  "size": {"width": 300, "height": 168}, "state": 2, "type": 1},
        "regions": [
            {"id": str(i), "type": "RECTANGLE", "tags": ["face"],
             "boundingBox": {"height": h, "width": w, "left": x, "top": y}, "points": [{"x": x, "y": y}]}
            for i, (x, y, w, h) in enumerate(regions)
        ],
        "version": "2.1.0",
    }


def test_asset_files(spark, tmp_path):
    (tmp_path / "a-asset.json").write_text(json.dumps(asset("a.jpg", (1.5, 2.5, 10.0, 20.0), (0.0, 0.0, 1.0, 1.0)), indent=2))
    (tmp_path / "b-asset.json").write_text(json.dumps(asset("b.jpg")))
    documents = annotations.read_documents(spark, str(tmp_path), "-asset.json")
    got = annotations.parse_assets(documents).orderBy("xmin").collect()
    assert len(got) == 2
    assert (got[1]["xmax"], got[1]["ymax"], got[1]["label"], got[1]["x_size"]) == (11.5, 22.5, "face", 300)


def test_annotation_csv(spark, tmp_path):
    (tmp_path / "x.csv").write_text('"image","xmin","ymin","xmax","ymax","label"\n"a.jpg",1.5,2,3,4,"cat"\n')
    assert tuple(annotations.read_annotations(spark, str(tmp_path / "x.csv")).first()) == ("a.jpg", 1.5, 2.0, 3.0, 4.0, "cat")


def test_detection_csv_round_trip(spark, tmp_path):
    rows = [("a b.jpg", "/p/a b.jpg", 1, 2, 3, 4, 0, 0.8169462084770203, 299, 168)]
    df = spark.createDataFrame(rows, annotations.DETECTION_SCHEMA)
    sinks.write_table(df, str(tmp_path / "d"), "csv")
    back = annotations.read_annotations(spark, str(tmp_path / "d"), annotations.DETECTION_SCHEMA)
    assert [tuple(r) for r in back.collect()] == rows
    sinks.write_table(df, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 1


def test_detections_from_predictions(spark):
    images = spark.createDataFrame(
        [("/p/a.jpg\n", 10, 20, [(1, 2, 3, 4, 0, 0.5), (2, 2, 3, 4, 1, 0.75)]), ("/p/b.jpg", 5, 5, [])],
        "image_path string, x_size int, y_size int, predictions array<struct<xmin:int,ymin:int,xmax:int,ymax:int,label:int,confidence:double>>",
    )
    got = ops.assemble_detections(images).collect()
    assert [r["image"] for r in got] == ["a.jpg", "a.jpg"]
    assert got[1]["confidence"] == 0.75 and got[0]["image_path"] == "/p/a.jpg"


def test_voc_keeps_known_and_not_difficult(spark):
    def item(name, difficult):
        return (f"<object><name>{name}</name><difficult>{difficult}</difficult><bndbox><xmin>1</xmin>"
                "<ymin>2</ymin><xmax>3</xmax><ymax>4</ymax></bndbox></object>")

    xml = "<annotation>" + item("cat", 0) + item("cat", 1) + item("dog", 0) + item("cow", 0) + "</annotation>"
    df = spark.createDataFrame([("f", xml), ("g", "<annotation></annotation>")], "path string, value string")
    got = annotations.parse_voc(df, ["dog", "cat"]).collect()
    assert [tuple(r) for r in got] == [("f", 1, 2, 3, 4, 1), ("f", 1, 2, 3, 4, 0)]


def test_relative_xml_axes(spark):
    xml = "<x>\n0.1\n</x>\n<y>\n0.2\n</y>\n<x>\n0.5\n</x>\n<y>\n0.6\n</y>\n<label>\n3\n</label>\n<labelname>\nwin\n</labelname>\n"
    df = spark.createDataFrame([("i", 100, 10, xml)], "image string, x_size int, y_size int, value string")
    swapped = annotations.parse_relative_xml(df).first()
    assert tuple(swapped)[1:5] == pytest.approx((20.0, 1.0, 60.0, 5.0))
    straight = annotations.parse_relative_xml(df, swapped=False).first()
    assert tuple(straight)[1:5] == pytest.approx((10.0, 2.0, 50.0, 6.0))
    assert (swapped["label"], swapped["code"]) == ("win", "3")


def test_line_and_crop_files(spark, tmp_path):
    df = spark.createDataFrame([("a.jpg", 1, 2, 3, 4, 0, "cat", 0.5)],
        "image string, xmin int, ymin int, xmax int, ymax int, code int, label string, confidence double")
    order = ["xmin", "ymin"]
    sinks.write_lines(ops.training_lines(df, order, "/d"), str(tmp_path / "t"))
    assert text.read_lines(spark, str(tmp_path / "t")).first()[0] == "/d/a.jpg 1,2,3,4,0"
    sinks.write_lines(ops.prediction_lines(df, order), str(tmp_path / "p"))
    assert text.read_lines(spark, str(tmp_path / "p")).first()[0] == "a.jpg 1,2,3,4,cat,0.5"
    sinks.write_crops(ops.crop_names(df, order), "/crops/", str(tmp_path / "c"))
    assert spark.read.csv(str(tmp_path / "c"), header=True).first()[0] == "/crops/a_cropped_cat_0.jpg"
    coded = df.drop("label").withColumn("label", F.lit(0))
    named = ops.crop_names(coded, order, labels={0: "house"}).first()["crop"]
    assert named == "a_cropped_house_0.jpg"


def test_materialize(spark):
    df = materialize(spark.range(5), "test")
    assert df.count() == 5
    assert shared_dir(spark)


def test_cluster_needs_a_shared_folder(monkeypatch):
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError):
        shared_dir(Session())


def test_incomplete_rows_are_counted(spark):
    lines = lines_of(spark, "1::2::3.5::4", "x::2::3.5::4", "1::2", "")
    parsed = records.parse_ratings(lines)
    assert tuple(records.complete_counts(parsed).first()) == (4, 1, 3)
    assert records.complete(parsed, "item").count() == 3
    points = records.parse_points(lines_of(spark, "2001,0.5,1.25", "2001,a", "2001", "y,1"))
    assert tuple(records.complete_counts(points).first()) == (4, 1, 3)
    series = records.parse_series(lines_of(spark, "3 4 1.5", "3 x 1.5", "3 4"))
    assert tuple(records.complete_counts(series).first()) == (3, 1, 2)
    boxes = annotations.parse_training_lines(lines_of(spark, "a.jpg 1,2,3,4,0 1,2,x,4,0 5,6"))
    assert tuple(records.complete_counts(boxes).first()) == (3, 1, 2)


def test_voc_objects_without_difficulty_count(spark):
    box = "<bndbox><xmin>1</xmin><ymin>2</ymin><xmax>3</xmax><ymax>4</ymax></bndbox>"
    xml = f"<annotation><object><name>dog</name>{box}</object><object><name>dog</name><difficult>1</difficult>{box}</object></annotation>"
    df = spark.createDataFrame([("p", xml)], "path string, value string")
    assert [tuple(r) for r in annotations.parse_voc(df, ["dog"]).collect()] == [("p", 1, 2, 3, 4, 0)]


def test_host_sketches_merge(spark):
    rows = [(f"h{i % 700}", f"2024-0{1 + i % 2}-{1 + i % 20:02d} 10:00:00") for i in range(4000)]
    logs_ = spark.createDataFrame(rows, "host string, date_time string").withColumn("date_time", F.to_timestamp("date_time"))
    sketches = materialize(reports.host_sketches(logs_), "sketches")
    (whole,) = reports.approx_hosts(sketches).collect()
    assert whole.period == "all" and abs(whole.n_hosts - 700) <= 35
    exact = {r.d: r.n for r in logs_.groupBy(F.month("date_time").cast("string").alias("d")).agg(F.countDistinct("host").alias("n")).collect()}
    for row in reports.approx_hosts(sketches, F.month("day")).collect():
        assert abs(row.n_hosts - exact[row.period]) <= 0.05 * exact[row.period]
    assert reports.approx_hosts(sketches.where("false")).first().n_hosts == 0


def test_load_counts_come_with_the_rows(spark):
    lines = ['"id","title","description","manufacturer","price"', '"a1","t","d","m","1"', "no record", '"a2","t","d","m","2"']
    parsed = records.parse_records(lines_of(spark, *lines))
    rows, found = records.load(parsed, max_bad=1, name="some")
    assert found == {"n_read": 4, "n_ok": 2, "n_header": 1, "n_bad": 1}
    assert sorted(r.id for r in rows.collect()) == ["a1", "a2"]
    with pytest.raises(ValueError, match="1 lines failed"):
        records.load(parsed, max_bad=0)
    with pytest.raises(ValueError, match="2 headers"):
        records.load(parsed.where("status <> 'bad'").unionByName(parsed.where("status = 'header'")), max_bad=0)
    assert records.load(parsed.where("false"), name="none")[1] == {"n_read": 0, "n_ok": 0, "n_header": 0, "n_bad": 0}


def test_a_bad_line_fails_the_job_that_reads_it(spark):
    good = '"a1","t","d","m","1"'
    assert records.valid(records.expect_valid(records.parse_records(lines_of(spark, good)))).count() == 1
    with pytest.raises(Exception, match="line failed to parse: no record"):
        records.expect_valid(records.parse_records(lines_of(spark, good, "no record"))).collect()


def test_line_numbers_of_split_files(spark, tmp_path):
    long = [f"line {i} " + "x" * (i % 37) for i in range(500)]
    (tmp_path / "a.txt").write_text("\n".join(long) + "\n")
    (tmp_path / "b.txt").write_text("one\n\nthree")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert spark.read.text(str(tmp_path / "a.txt")).rdd.getNumPartitions() > 10
        rows = text.numbered_lines(spark, str(tmp_path)).collect()
        names = text.read_class_names(spark, str(tmp_path / "a.txt")).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    got = {name: [v for _, v in sorted((r.line, r.value) for r in rows if r.path.endswith(name))] for name in ("a.txt", "b.txt")}
    assert got == {"a.txt": long, "b.txt": ["one", "", "three"]}
    assert sorted(r.line for r in rows if r.path.endswith("a.txt")) == list(range(500))
    assert sorted((r.code, r.label) for r in names) == [(i, v.strip()) for i, v in enumerate(long)]


def test_class_names_end_with_empty_lines(spark, tmp_path):
    (tmp_path / "c.txt").write_text("a\n\nb\n\n\n")
    assert [tuple(r) for r in text.read_class_names(spark, str(tmp_path / "c.txt")).orderBy("code").collect()] == [(0, "a"), (1, ""), (2, "b")]
    (tmp_path / "d.txt").write_text("")
    assert text.read_class_names(spark, str(tmp_path / "d.txt")).count() == 0


def test_compressed_lines_and_folders(spark, tmp_path):
    rows = spark.createDataFrame([(f"l{i}", i % 2, i % 3) for i in range(30)], "line string, a int, b int")
    sinks.write_lines(rows.repartition(2), str(tmp_path / "z"), codec="gzip", by=["a", "b"])
    files = text.list_files(spark, str(tmp_path / "z"), (".gz",)).collect()
    assert len(files) >= 6 and all("/a=" in r.path and "/b=" in r.path for r in files)
    assert text.read_lines(spark, str(tmp_path / "z"), min_partitions=7).select("value").distinct().count() == 30
    sinks.write_lines(rows.coalesce(1), str(tmp_path / "one"), codec="gzip")
    assert text.read_lines(spark, str(tmp_path / "one")).rdd.getNumPartitions() == 1
    assert text.read_lines(spark, str(tmp_path / "one"), min_partitions=5).rdd.getNumPartitions() == 5


def test_file_list_reads_no_content(spark, tmp_path):
    (tmp_path / "a.jpg").write_text("x")
    plan = text.list_files(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_annotations_with_quotes_breaks_and_rejects(spark, tmp_path):
    label = 'a "b", c\nd'
    rows = spark.createDataFrame([("i.jpg", "1.5", "2", "3", "4", label), ("j.jpg", "x", "2", "3", "4", "e"), ("k.jpg", None, "2", "3", "4", None)], "image string, xmin string, ymin string, xmax string, ymax string, label string")
    sinks.write_table(rows, str(tmp_path / "csv"), kind="csv")
    read = annotations.read_annotations(spark, str(tmp_path / "csv"), rejects=True, multiline=True)
    good, counts = annotations.split_rejects(read)
    assert tuple(counts.first()) == (3, 2, 1)
    got = {r.image: tuple(r)[1:] for r in good.collect()}
    assert got == {"i.jpg": (1.5, 2.0, 3.0, 4.0, label), "k.jpg": (None, 2.0, 3.0, 4.0, None)}
