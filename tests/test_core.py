"""The library's own operators: boxes, formats, splits, duplicates, pixels, settings, the image pipeline."""

import json
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from prismset import config as C
from prismset.functions import boxes as B
from prismset.operators import dedup, pixels, split
from prismset.plans import autolabel, catalogue, dataset, flat
from prismset.sources import annotations as A
from prismset.sources import files
from prismset.streaming import ingest

GOOD = {
    "input_path": "images", "output_path": "data/processed/v001", "rejected_path": "data/rejected", "reports_path": "reports", "experiments_path": "experiments/v001", "classes": {0: "grape"},
    "split": {"train": 0.7, "validation": 0.15, "test": 0.15, "seed": 42}, "resize": {"target_size": 64}, "quality": {"blur": {"threshold": 5.0}, "min_box_area_ratio": 0.0001, "max_box_area_ratio": 0.99},
    "deduplication": {"method": "phash", "threshold": 4}, "augmentation": {"rotation": {"probability": 1.0}},
}


def one(spark, schema, *row):
    return spark.createDataFrame([row], schema)


def test_boxes(spark):
    cols = [F.col(c) for c in "xywh"]
    df = one(spark, "x double, y double, w double, h double", 0.05, 0.5, 0.4, 0.4)
    got = df.select(*(v.alias(k) for k, v in B.sanitize(*cols).items())).first()
    assert (got.x, got.w) == (0.125, 0.25)
    df = one(spark, "x double, y double, w double, h double", 0.5, 0.5, 0.5, 0.5)
    got = df.select(*(v.alias(k) for k, v in B.letterbox_box(*cols, F.lit(400.0), F.lit(200.0), 640).items()), *(v.alias(k) for k, v in B.letterbox(F.lit(400.0), F.lit(200.0), 640).items())).first()
    assert (got.y, got.h, got.scale, got.pad_w, got.pad_h) == (0.5, 0.25, 1.6, 0.0, 160.0)


@pytest.mark.parametrize(
    "box, want",
    [((1, 0.5, 0.5, 0.1, 0.1), "class"), ((0, -0.1, 0.5, 0.1, 0.1), "x"), ((0, 0.5, 1.1, 0.1, 0.1), "y"), ((0, 0.5, 0.5, 0.0, 0.1), "nonpos"), ((0, 0.5, 0.5, 1.1, 0.1), "dim"),
     ((0, 0.5, 0.5, 0.001, 0.001), "area_min"), ((0, 0.5, 0.5, 1.0005, 1.0005), "area_max"), ((0, 0.9, 0.5, 0.4, 0.1), "edge"), ((0, 0.5, 0.5, 1.0, 1.0), None), ((0, float("nan"), 0.5, 0.1, 0.1), "x"), ((0, 0.5, 0.5, float("nan"), 0.1), "dim")],
)
def test_box_reasons(spark, box, want):
    df = one(spark, "c int, x double, y double, w double, h double", *box)
    assert df.select(B.reason(*(F.col(k) for k in "cxywh"), [0]).alias("r")).first().r == want


def test_formats(spark):
    lines = ["0 .5 .5 .1 .1", "0.0 .5 .5 .1 .1", "0.5 .5 .5 .1 .1", "0 .5 .5 .1", "0 .5 .5 .1 .1 .9", "a b c d e", "", "0 1.1 .5 .1 .1"]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(lines)], "k int, line string")
    assert sorted(r.k for r in A.yolo_strict(df, "line", [0]).collect()) == [0, 1]
    assert sorted(r.k for r in A.yolo_lenient(df, "line").collect()) == [0, 1, 2, 4]
    voc = "<annotation><size><width>100</width><height>50</height></size><object><name>{}</name><bndbox><xmin>10</xmin><ymin>5</ymin><xmax>{}</xmax><ymax>25</ymax></bndbox></object></annotation>"
    df = spark.createDataFrame([(1, voc.format("grape", 30)), (2, voc.format("weed", 30)), (3, voc.format("grape", 10)), (4, "<annotation><size>")], "k int, xml string")
    got = {r.k: r for r in A.voc_boxes(df, "xml", {"grape": 0}, F.lit(10), F.lit(10)).collect()}
    assert got[1].valid and (got[1].boxes[0].x, got[1].boxes[0].w) == (0.2, 0.2) and got[2].error == "unknown class" and got[3].boxes == [] and not got[4].valid
    files = [("a", "x.json", '{"images": [], "annotations": []}'), ("a", "x.txt", "0 .5 .5 .1 .1"), ("b", "x.xml", "<annotation/>"), ("b", "x.txt", "0 .5 .5 .1 .1"), ("c", "x.txt", "0 .5 .5 .1 .1\nbad"), ("c", "y.txt", "0.0 .5 .5 .1 .1"), ("d", "x.txt", "0 .5 .5 .1 .1\nbad"), ("e", "classes.txt", "grape"), ("e", "x.png", "")]
    got = {r.subfolder: r.fmt for r in A.detect(spark.createDataFrame(files, "subfolder string, name string, content string")).collect()}
    assert got == {"a": "coco_json", "b": "voc_xml", "c": "yolo_txt", "d": "custom", "e": "none"}


@pytest.mark.parametrize("n, want", [(98, (69, 15, 14)), (61, (43, 9, 9)), (60, (42, 9, 9)), (15, (10, 2, 3))])
def test_group_split_counts(spark, n, want):
    got = split.group_split(spark.range(n).withColumn("s", F.lit("a")), "s", "id").groupBy("split").count().collect()
    assert tuple({r.split: r["count"] for r in got}[k] for k in ("train", "val", "test")) == want


def test_flat_split_counts(spark):
    got = {r.split: r["count"] for r in split.flat_split(spark.range(234), "id").groupBy("split").count().collect()}
    assert (got["train"], got["val"], got["test"]) == (163, 35, 36)


def test_leaders_are_not_components(spark):
    chain = spark.createDataFrame([(0, 0, 0), (1, 0b111, 0), (2, 0b111111, 0), (3, 0, 0xFF)], "i long, lo long, hi long")
    pairs = dedup.near_pairs(chain, 4)
    assert sorted((r.i, r.j) for r in pairs.collect()) == [(0, 1), (1, 2)]
    assert [(r.leader, r.member) for r in dedup.leader_groups(pairs).collect()] == [(0, 1)]
    rng = np.random.default_rng(0)
    h = rng.integers(0, 1 << 16, (200, 2))
    df = spark.createDataFrame([(k, int(a), int(b)) for k, (a, b) in enumerate(h)], "i long, lo long, hi long")
    want = [(i, j) for i in range(200) for j in range(i + 1, 200) if int(h[i, 0] ^ h[j, 0]).bit_count() + int(h[i, 1] ^ h[j, 1]).bit_count() <= 8]
    assert sorted((r.i, r.j) for r in dedup.near_pairs(df, 8).collect()) == want
    lead, member = set(), {}
    for i in range(200):
        if i not in member:
            for a, b in want:
                if a == i and b not in member:
                    member[b] = i
    assert {r.member: r.leader for r in dedup.leader_groups(dedup.near_pairs(df, 8)).collect()} == member


def test_pixels():
    flat, board = np.full((32, 32, 3), 90, np.uint8), (np.indices((32, 32)).sum(0) % 2 * 255).astype(np.uint8)[..., None].repeat(3, 2)
    assert pixels.blur_variance(flat) == 0 and pixels.blur_variance(board) == pytest.approx(1_040_400)
    assert pixels.letterbox(np.zeros((200, 400, 3), np.uint8), 640).shape == (640, 640, 3)
    rng = np.random.default_rng(0)
    a = pixels.resize(rng.integers(0, 255, (8, 8, 3)), 64, 64).astype(np.uint8)
    for m in ("phash", "dhash", "ahash"):
        d = (pixels.perceptual_hash(a, m) ^ pixels.perceptual_hash(np.clip(a + 5.0, 0, 255).astype(np.uint8), m)) & (1 << 64) - 1
        assert d.bit_count() <= 8
    box = np.array([[0, 0.3, 0.5, 0.2, 0.2]])
    assert pixels.flip(a, box)[1][0, 1] == 0.7
    x, y = pixels.augment(a, box, {}, "k"), pixels.augment(a, box, {}, "k")
    assert (x[0] == y[0]).all() and (x[1] == y[1]).all()
    assert (np.abs(pixels.shift_hsv(a, 0, 0, 0).astype(int) - a) <= 1).all()
    assert pixels.augment(a, np.zeros((0, 5)), {}, "k")[0] is a


def test_settings(tmp_path):
    c = C.check(GOOD, tmp_path)
    assert c["output_path"] == str(tmp_path.resolve() / "data/processed/v001")
    for change, what in (({"output_path": ".."}, "must stay inside"), ({"split": GOOD["split"] | {"test": 0.2}}, "sum to 1.0"), ({"classes": {-1: "a"}}, "class"), ({"resize": {"target_size": 0}}, "positive"), ({"deduplication": {"threshold": 65}}, "0 to 64")):
        with pytest.raises(ValueError, match=re.escape(what)):
            C.check(GOOD | change, tmp_path)
    with pytest.raises(C.SettingsError) as e:
        C.check({k: v for k, v in GOOD.items() if k != "classes"} | {"augmentation": {"hsv": {"probability": 2}}, "quality": {"min_box_area_ratio": 0.5, "max_box_area_ratio": 0.1}}, tmp_path)
    assert len(e.value.complaints) == 3


def test_image_pipeline(spark, tmp_path):
    rng = np.random.default_rng(5)
    for k in range(12):
        d = tmp_path / "images" / f"s{k % 2}"
        d.mkdir(parents=True, exist_ok=True)
        (d / f"i{k}.png").write_bytes(pixels.png(rng.integers(0, 255, (40, 60, 3)).astype(np.uint8)))
        (d / f"i{k}.txt").write_text("0 0.5 0.5 0.4 0.4\n")
    d = tmp_path / "images" / "s0"
    (d / "i0copy.png").write_bytes((d / "i0.png").read_bytes())
    (d / "i0copy.txt").write_text("0 0.5 0.5 0.4 0.4\n")
    (d / "broken.png").write_bytes((d / "i0.png").read_bytes()[:40])
    (d / "flat.png").write_bytes(pixels.png(np.full((40, 60, 3), 9, np.uint8)))
    (d / "flat.txt").write_text("0 0.5 0.5 0.4 0.4\n")
    (d / "bare.png").write_bytes(pixels.png(rng.integers(0, 255, (40, 60, 3)).astype(np.uint8)))
    (d / "HorFlip_i2.png").write_bytes((d / "i2.png").read_bytes())
    c = C.check(GOOD | {"input_path": str(tmp_path / "images")}, tmp_path)
    (d / "bare2.png").write_bytes(pixels.png(rng.integers(0, 255, (40, 60, 3)).astype(np.uint8)))
    (d / "bare2.txt").write_text("not a box\n")
    (d / "bare3.png").write_bytes(pixels.png(rng.integers(0, 255, (40, 60, 3)).astype(np.uint8)))
    (d / "bare3.txt").write_text("")
    (d / "deep/RGB-D").mkdir(parents=True)
    (d / "deep/RGB-D/x.png").write_bytes((d / "i2.png").read_bytes())
    got = dataset.run(spark, c)
    assert got["summary"]["statuses"] == {"valid": 12, "corrupted": 1, "duplicate": 1, "low_quality": 1, "unannotated": 1, "invalid_annotation": 2}
    every = next(r for r in got["ingestion_report"] if r["subfolder"] == "(all)")
    assert (every["total"], every["valid"], every["variants"], every["excluded_modality"]) == (18, 14, 1, 1)
    assert (got["annotation_report"]["records"], got["annotation_report"]["invalid_records"], got["annotation_report"]["classes"]) == (16, 2, {"grape": 14})
    assert [r["reason"] for r in got["malformed_labels"]] == ["malformed"]
    assert (got["deduplication_report"]["exact"], got["deduplication_report"]["near"], got["deduplication_report"]["by_subfolder"]) == (1, 0, {"s0": 1})
    assert got["quality_report"]["blurred"] == 1 and len(got["quality_report"]["rejections"]) == 1 and not got["normalization"]["enabled"]
    assert sum(r["images"] for r in got["output_report"]) == 12
    out = tmp_path / "data/processed/v001"
    assert len(list(out.glob("*/images/*.png"))) == len(list(out.glob("*/labels/*.txt"))) == 12 and (out / "data.yaml").exists()
    assert json.loads((tmp_path / "reports/split_report.json").read_text()) == got["split_report"]
    assert got["final_integrity_report"]["valid"] and got["previews"] == {"before": 6, "after": 6} and got["dataset_statistics"]["after"]["quarantined_images"] == 5
    assert sum(r["boxes"] for r in got["output_report"]) == sum(got["final_integrity_report"][s]["boxes"] for s in ("train", "val", "test"))
    copied = sorted(p.relative_to(tmp_path / "data/rejected").as_posix() for p in (tmp_path / "data/rejected").rglob("*.png"))
    assert copied == ["corrupted/s0_broken.png", "duplicate/s0_i0copy.png", "invalid_annotation/s0_bare2.png", "invalid_annotation/s0_bare3.png", "low_quality/s0_flat.png"]
    (out / "train/labels/extra.txt").write_text("0 1.5 0.5 0.1 0.1\n")
    again = dataset.integrity(spark, c)
    assert not again["valid"] and len(again["errors"]) == 2
    with pytest.raises(FileExistsError):
        dataset.run(spark, c)


def test_scan_reads_each_subfolder_in_its_format(spark, tmp_path):
    png = pixels.png(np.random.default_rng(1).integers(0, 255, (40, 60, 3)).astype(np.uint8))
    for d, names in {"voc": "abc", "coco": "abcd", "yolo": "ab"}.items():
        (tmp_path / d / "deep").mkdir(parents=True)
        for n in names:
            (tmp_path / d / "deep" / f"{n}.png").write_bytes(png)
    size = "<size><width>60</width><height>40</height></size>"
    one = "<object><name>{}</name><bndbox><xmin>6</xmin><ymin>4</ymin><xmax>30</xmax><ymax>20</ymax></bndbox></object>"
    name = GOOD["classes"][0]
    (tmp_path / "voc/deep/a.xml").write_text(f"<annotation>{size}{one.format(name)}</annotation>")
    (tmp_path / "voc/deep/b.xml").write_text(f"<annotation>{size}{one.format('other')}</annotation>")
    (tmp_path / "yolo/deep/a.txt").write_text("0 0.3 0.3 0.4 0.4\n")
    coco = {"images": [{"id": k, "file_name": f, "width": 60, "height": 40} for k, f in enumerate(["a.png", "b.jpg", "c.png"])], "categories": [{"id": 7, "name": name}]}
    coco["annotations"] = [{"image_id": k, "category_id": 7, "bbox": [6, 4, 24, 16]} for k in range(2)]
    (tmp_path / "coco/all.json").write_text(json.dumps(coco))
    got = {(r.subfolder, r.stem): r for r in dataset.scan(spark, {"input_path": str(tmp_path), "classes": {0: name}}).select("subfolder", "stem", "status", "boxes").collect()}
    want = {("voc", "a"): "valid", ("voc", "b"): "invalid_annotation", ("voc", "c"): "unannotated", ("yolo", "a"): "valid", ("yolo", "b"): "unannotated"}
    want |= {("coco", "a"): "valid", ("coco", "b"): "valid", ("coco", "c"): "invalid_annotation", ("coco", "d"): "unannotated"}
    assert {k: r.status for k, r in got.items()} == want
    for k, status in want.items():
        assert [tuple(b) for b in got[k].boxes] == ([pytest.approx((0, 0.3, 0.3, 0.4, 0.4))] if status == "valid" else [])


def test_the_first_coco_file_counts(spark, tmp_path):
    """One file for each subfolder, the last of repeated image ids, sizes that are positive."""
    images = [{"id": 1, "file_name": "old.png", "width": 10, "height": 10}, {"id": 1, "file_name": "a.png", "width": 60, "height": 40}, {"id": 2, "file_name": "b.png", "width": 0, "height": 40}]
    notes = [{"image_id": k, "category_id": 5, "bbox": [6, 4, 24, 16]} for k in (1, 2)]
    cats = [{"id": 5, "name": "other"}, {"id": 5, "name": "grape"}]
    text = json.dumps({"images": images, "annotations": notes, "categories": cats})
    df = spark.createDataFrame([("x", text)], "f string, c string")
    assert [(r.file_name, r.class_id) for r in A.coco_boxes(df, "f", "c", {"grape": 0}).collect()] == [("a.png", 0)]
    rows = [("s", "s/b.json", "json", "coco_json"), ("s", "s/a.json", "json", "coco_json"), ("s", "s/0.txt", "txt", "coco_json"), ("t", "t/0.json", "json", "custom")]
    files = spark.createDataFrame(rows, "folder string, lpath string, ext string, fmt string")
    assert [tuple(r) for r in dataset.first_json(files).collect()] == [("s", "s/a.json")]


def test_custom_formats(spark):
    df = spark.createDataFrame([("a.lab",)], "path string")
    got = A.custom_boxes(df, "lab").first()
    assert not got.valid and "lab" in got.error
    assert A.custom_boxes(df, "lab", lambda f: f.selectExpr("path", "true AS valid")).first().valid


def test_input_folder(tmp_path, monkeypatch):
    (tmp_path / "work").mkdir()
    (tmp_path / "images").mkdir()
    monkeypatch.chdir(tmp_path / "work")
    assert files.input_folder("images") == (tmp_path / "images").resolve().as_posix()
    assert files.input_folder("hdfs://host/images/") == "hdfs://host/images"
    with pytest.raises(FileNotFoundError):
        files.input_folder("nowhere")


def test_copies_share_a_split(spark):
    """A duplicate group is the unit of the split, else the source image."""
    rows = [(f"p{k}", "s", f"src{k // 2}", "valid", "p0" if k in (0, 7) else None, []) for k in range(40)]
    df = spark.createDataFrame(rows, f"path string, subfolder string, provenance string, status string, grp string, boxes {dataset.BOX}")
    got = {r.path: r.split for r in dataset.split_images(df, {"split": GOOD["split"]}).collect()}
    assert got["p0"] == got["p7"] and all(got[f"p{k}"] == got[f"p{k + 1}"] for k in range(8, 40, 2)) and len(got) == 40


def test_flat_pipeline(spark, tmp_path):
    (tmp_path / "images/deep").mkdir(parents=True)
    (tmp_path / "labels").mkdir()
    png = pixels.png(np.zeros((4, 4, 3), np.uint8))
    for k in range(20):
        (tmp_path / f"images/i{k}.PNG").write_bytes(png)
        if k < 17:
            (tmp_path / f"labels/i{k}.txt").write_text("0.0 .5 .5 .1 .1 .9\nbad\n" * (k % 3))
    (tmp_path / "images/deep/no.png").write_bytes(png)
    (tmp_path / "out/old").mkdir(parents=True)
    got = flat.run(spark, *(str(tmp_path / d) for d in ("images", "labels", "out", "reports")), {0: "grape"})
    assert (got["images"], got["labelled"], got["unlabelled"], got["boxes"]) == (20, 17, 3, sum(k % 3 for k in range(17)))
    assert {k: v["images"] for k, v in got["splits"].items()} == {"train": 11, "val": 2, "test": 4} and got["valid"]
    out = tmp_path / "out"
    assert not (out / "old").exists() and len(list(out.glob("*/images/*.PNG"))) == 17 and "0: grape" in (out / "data.yaml").read_text()
    assert next(out.glob("*/labels/i1.txt")).read_text() == "0 0.500000 0.500000 0.100000 0.100000\n" and next(out.glob("*/labels/i0.txt")).read_text() == ""
    assert json.loads((tmp_path / "reports/final_integrity_report.json").read_text()) == got


def test_auto_label(spark, tmp_path):
    png = pixels.png(np.zeros((20, 30, 3), np.uint8))
    for n in "ab":
        (tmp_path / f"{n}.png").write_bytes(png)
    (tmp_path / "b.xml").write_text("<annotation/>")
    made = autolabel.label(spark, str(tmp_path), lambda a: np.array([[-5, 2, 12.7, 9, 0.9], [1, 1, 5, 5, 0.4], [40, 1, 50, 5, 0.8]]), "a & b")
    assert [(r.path.rsplit("/", 1)[1], r.boxes) for r in autolabel.write(made).collect()] == [("a.png", 1)]
    text = (tmp_path / "a.xml").read_text()
    assert "<name>a &amp; b</name><bndbox><xmin>0</xmin><ymin>2</ymin><xmax>12</xmax><ymax>9</ymax>" in text
    assert autolabel.label(spark, str(tmp_path), lambda a: np.zeros((0, 5)), "x").count() == 0


def test_command_line(tmp_path, monkeypatch, capsys):
    import yaml

    from prismset import cli

    monkeypatch.chdir(tmp_path)
    assert cli.main(["--config", "none.yaml"]) == 1
    (tmp_path / "c.yaml").write_text(yaml.safe_dump(GOOD | {"resize": {"target_size": 0}}))
    assert cli.main(["--config", "c.yaml", "--seed", "-1"]) == 2
    said = capsys.readouterr().err
    assert "resize.target_size" in said and "split.seed" in said


def test_phash_is_the_low_cosine_terms():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 255, (32, 32, 1)).astype(np.uint8).repeat(3, 2)
    g = a[:, :, 0].astype(float)
    low = np.array([[sum(g[y, x] * np.cos(np.pi * u * (2 * y + 1) / 64) * np.cos(np.pi * v * (2 * x + 1) / 64) for y in range(32) for x in range(32)) for v in range(8)] for u in range(8)])
    bits = (low > np.median(low)).ravel()
    assert pixels.perceptual_hash(a) == sum(1 << 63 - k for k in range(64) if bits[k]) - (1 << 63)


def test_rotation_and_blur():
    a = np.zeros((21, 21, 3), np.uint8)
    a[10, 15] = 200
    out, boxes = pixels.rotate(a, np.array([[0, 0.75, 0.5, 0.1, 0.1]]), 90)
    assert out[5, 10, 0] == 200 and boxes[0, 1:3] == pytest.approx([0.5, 0.25]) and boxes[0, 3:] == pytest.approx([0.1, 0.1])
    assert pixels.motion_blur(a, 5, False)[10, 13:18, 0].tolist() == [40] * 5 and (pixels.brightness_contrast(a, 0.1, 0.5)[10, 15] == 255).all()


def test_ordinal_and_wide_pairs(spark):
    df = spark.range(0, 500).selectExpr("id * 7 % 1000 AS r").distinct()
    got = sorted((r.r, r.name) for r in dedup.ordinal(df, "g", "r").collect())
    assert [n for _, n in got] == [f"g{k + 1}" for k in range(len(got))]
    rng = np.random.default_rng(4)
    h = rng.integers(0, 1 << 8, (60, 2))
    h[50:] = h[:10]
    rows = [(k, int(a), int(b)) for k, (a, b) in enumerate(h)]
    df = spark.createDataFrame(rows, "i long, lo long, hi long")
    far = lambda i, j: int(h[i, 0] ^ h[j, 0]).bit_count() + int(h[i, 1] ^ h[j, 1]).bit_count()
    for t in (0, 3, 13):
        want = [(i, j) for i in range(60) for j in range(i + 1, 60) if far(i, j) <= t]
        assert sorted((r.i, r.j) for r in dedup.near_pairs(df, t).collect()) == want
        member = {}
        for i in range(60):
            if i not in member:
                member |= {b: i for a, b in want if a == i and b not in member}
        assert {r.member: r.leader for r in dedup.near_leaders(df, t).collect()} == member


def _built(df) -> int:
    """Rows that the broadcasts of a finished plan hold."""
    plan = df._jdf.queryExecution().executedPlan()
    todo, rows = [plan], 0
    while todo:
        p = todo.pop()
        name = p.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(p.executedPlan())
        elif name.endswith("QueryStage"):
            todo.append(p.plan())
        else:
            if name == "BroadcastExchange":
                rows += p.metrics().apply("numOutputRows").value()
            todo += [p.children().apply(k) for k in range(p.children().size())]
    return rows


@pytest.mark.parametrize("t", [8, 14])
def test_pairs_are_not_broadcast(spark, tmp_path, t):
    """Small files whose rows are multiplied for the join: no side of it goes through the driver."""
    spark.range(3000).selectExpr("id AS i", "crc32(CAST(id div 2 AS STRING)) ^ (id % 2) AS lo", "crc32(CAST(-(id div 2) AS STRING)) AS hi").write.parquet(str(tmp_path / "h"))
    df = dedup.near_pairs(spark.read.parquet(str(tmp_path / "h")), t)
    assert len(df.collect()) >= 1500 and _built(df) == 0


def test_report_broadcasts_its_counts_only(spark, tmp_path):
    """Small files of many distinct texts, null ones too: nothing that grows with them goes through the driver."""
    spark.range(3000).selectExpr("id AS doc_id", "IF(id % 1000 = 7, NULL, 'box ' || (id - IF(id % 5 = 4, 1, 0))) AS text").write.parquet(str(tmp_path / "documents.parquet"))
    df = catalogue.QUERIES["dedup_report"](spark, str(tmp_path))
    (got,) = df.collect()
    assert (got.evaluated, got.exact) == (3000, 602) and _built(df) == 3
    df = dedup.first_of(spark.read.parquet(str(tmp_path / "documents.parquet")), F.col("text"), "doc_id")
    same = {r.doc_id: r.representative for r in df.collect()}
    assert same == {k: 7 if k % 1000 == 7 else k - (k % 5 == 4) for k in range(3000)} and _built(df) == 0


def test_pairs_of_many_blocks(spark, monkeypatch):
    """Blocks and tiles of a few rows, repeated and null ids and hashes: the pairs of brute force."""
    monkeypatch.setattr(dedup, "LEAST_BLOCK", 16)
    monkeypatch.setattr(dedup, "TILE", 8)
    rng = np.random.default_rng(6)
    h = [(k, int(a), int(b)) for k, (a, b) in enumerate(rng.integers(0, 1 << 32, (400, 2)))]
    h += [(k + 400, a ^ 0x80000FFF, b ^ 0x80000000) for k, a, b in h[:50]] + [(3, 5, 6), (3, 5, 7), (4, 5, 7), (4, 5, 7)]
    want = {(a[0], b[0], d) for a in h for b in h if a[0] < b[0] and (d := (a[1] ^ b[1]).bit_count() + (a[2] ^ b[2]).bit_count()) <= 14}
    df = spark.createDataFrame([*h, (None, 5, 6), (900, None, 6), (901, 5, None)], "i long, lo long, hi long")
    got = [tuple(r) for r in dedup.near_pairs(df, 14).collect()]
    assert len(want) > 50 and sorted(got) == sorted(want)


def test_label_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_text("0 .5 .5 .1 .1\nbad\n")
    for k in range(2):
        ingest.start(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck"), [0]).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "out")).count() == 2 + k
        (tmp_path / "in/b.txt").write_text("3 .5 .5 .1 .1\n")
    assert {r.reason for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {None, "malformed", "class"}


def test_catalogue():
    assert len(catalogue.QUERIES) > 60 and set(catalogue.ORACLES) <= set(catalogue.QUERIES)
