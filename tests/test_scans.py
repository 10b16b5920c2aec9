"""File sources (SRC-1..10) on small files written into pytest's temporary folder."""

import json
import os

import pytest

from pyspark.sql import functions as F

from yardstick.operators import extract, sampling
from yardstick.sources import scans


def _write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def _line(i, text="<reasoning>r</reasoning>Yes"):
    return json.dumps({"recordId": f"sample_{i}", "modelOutput": {"content": [{"type": "text", "text": text}]}})


def test_discovery_prefers_flat_then_recursive(spark, tmp_path):
    d = str(tmp_path / "out")
    _write(f"{d}/nested/batch_0/a.jsonl.out", [_line(1)])
    _write(f"{d}/top.jsonl", [_line(2)])
    got = scans.discover_raw_lines(spark, d).collect()
    assert [json.loads(r.value)["recordId"] for r in got] == ["sample_2"]  # flat *.jsonl beats recursive *.jsonl.out
    _write(f"{d}/b.jsonl.out", [_line(3), "", "{broken"])
    got = scans.discover_raw_lines(spark, d)
    parsed = extract.parse_raw_lines(got, "contains").collect()
    assert sorted(r.sample_id for r in parsed if r.sample_id is not None) == [3]
    assert sorted(r.drop_reason or "ok" for r in parsed) == ["malformed", "ok"]


def test_raw_scan_keeps_file_and_order(spark, tmp_path):
    d = str(tmp_path / "raw")
    _write(f"{d}/ds/m/batch_1/x.jsonl.out", [_line(5, "No"), _line(5, "<reasoning>r</reasoning>yes")])
    lines = scans.raw_output_text(spark, d)
    preds = extract.raw_predictions(lines, d)
    from yardstick.operators.align import last_write_wins

    r = last_write_wins(preds).collect()
    assert len(r) == 1 and r[0].prediction == "yes"  # the later line wins


def test_tolerant_parts_json(spark, tmp_path):
    d = str(tmp_path / "parts")
    _write(f"{d}/part-0.json", [json.dumps({"sample": 1, "prediction": "Yes", "batch_path": "o/ds/m/x"}), "", "not json"])
    df = scans.parts_json(spark, d)
    rows = df.collect()
    assert sum(r.malformed for r in rows) == 1
    assert [r.sample for r in rows if not r.malformed] == [1]


def test_is_parts_record(spark):
    df = spark.createDataFrame([('{"sample": 1, "prediction": "no"}',), ('{"sample": 1}',), ("x",)], "value string")
    assert [r[0] for r in df.select(scans.is_parts_record()).collect()] == [True, False, False]


def test_missing_shards(spark, tmp_path):
    a = str(tmp_path / "shard-a")
    spark.range(3).write.parquet(a)
    df, skipped = scans.robust_dataset(spark, [a, str(tmp_path / "shard-missing")])
    assert (df.count(), skipped) == (3, 1)
    try:
        scans.robust_dataset(spark, [str(tmp_path / "none")])
        raise AssertionError("expected FileNotFoundError")
    except FileNotFoundError:
        pass


def test_cached_or_build(spark, tmp_path):
    p = str(tmp_path / "cache")
    first = scans.cached_or_build(spark, p, lambda: spark.range(5)).count()
    again = scans.cached_or_build(spark, p, lambda: spark.range(50)).count()
    forced = scans.cached_or_build(spark, p, lambda: spark.range(7), force=True).count()
    assert (first, again, forced) == (5, 5, 7)


def test_resolve_images(spark, tmp_path):
    img = tmp_path / "img.png"
    img.write_bytes(b"\x89PNG")
    df = spark.createDataFrame(
        [(1, (b"raw", None)), (2, (b"", str(img))), (3, (None, None))],
        "id int, image struct<bytes: binary, path: string>",
    )
    files = spark.read.format("binaryFile").load(str(tmp_path / "*.png"))
    got = {r.id: r for r in scans.resolve_images(df, "image", files).collect()}
    assert bytes(got[1].image_bytes) == b"raw" and bytes(got[2].image_bytes) == b"\x89PNG"
    assert got[3].image_bytes is None and got[3].image_error is not None


def test_manifest_roundtrip(spark, tmp_path):
    sampled = spark.createDataFrame([("r", "accepted", 3), ("r", "x", 1), ("s", "accepted", 2)], "split string, category string, sample_id bigint")
    doc = sampling.manifest_document(sampling.manifest_lists(sampled))
    p = str(tmp_path / "manifest")
    doc.write.json(p)
    rows = sampling.manifest_rows(spark.read.json(p))
    assert sorted(map(tuple, rows.collect())) == [("r", 1), ("r", 3), ("s", 2)]


def test_manifest_of_missing_and_oddly_named_categories(spark):
    rows = [("r", None, 5), ("r", "*all*", 1), ("r", "x", 3)]
    sampled = spark.createDataFrame(rows, "split string, category string, sample_id bigint")
    doc = sampling.manifest_document(sampling.manifest_lists(sampled)).collect()
    assert len(doc) == 1
    assert doc[0].categories == {"null": [5], "*all*": [1], "x": [3]} and doc[0].all_indices == [1, 3, 5]


@pytest.mark.parametrize("form", ["{}", "{}/", "file:{}", "file://{}", "file://{}//"])
def test_discovery_chooses_the_flat_class_for_every_spelling(spark, tmp_path, form):
    d = str(tmp_path / "outs")
    _write(f"{d}/a.jsonl.out", [_line(1)])
    _write(f"{d}/deeper/b.jsonl.out", [_line(2)])
    assert scans.discover_raw_lines(spark, form.format(d)).count() == 1


def test_mapping_parse():
    assert scans.parse_mapping(["a=/x=y", " b = /z "]) == {"a": "/x=y", "b": "/z"}


def test_discovery_skips_unselected_large_inputs(spark, tmp_path):
    d = str(tmp_path / "out2")
    _write(f"{d}/batch_0.jsonl", ["{\"recordId\": \"sample_1\", \"payload\": \"" + "A" * 1000 + "\"}"])
    _write(f"{d}/batch_0.jsonl.out", [_line(1)])
    lines = scans.discover_raw_lines(spark, d)
    files = {r.source_file.rsplit("/", 1)[-1] for r in lines.select("source_file").distinct().collect()}
    assert files == {"batch_0.jsonl.out"}


def test_discover_parts(spark, tmp_path):
    d = str(tmp_path / "p")
    rec = lambda i: json.dumps({"sample": i, "prediction": "yes", "batch_path": "o/ds/m/x"})
    _write(f"{d}/run/part-00000.json", [rec(1)])
    _write(f"{d}/run/metrics.json", [rec(8)])
    assert sorted(r.sample for r in scans.discover_parts(spark, d).collect()) == [1]
    _write(f"{d}/flat.json", [rec(2)])
    assert sorted(r.sample for r in scans.discover_parts(spark, d).collect()) == [2]


def test_flat_metrics_json_stops_the_recursive_search(spark, tmp_path):
    # as in the reference: any flat *.json selects the flat class, metrics.json is then
    # skipped, and part files in sub-folders are not searched
    d = str(tmp_path / "p")
    rec = lambda i: json.dumps({"sample": i, "prediction": "yes", "batch_path": "o/ds/m/x"})
    _write(f"{d}/run/part-00000.json", [rec(1)])
    _write(f"{d}/metrics.json", [json.dumps({"accuracy": 1.0})])
    assert scans.discover_parts(spark, d).count() == 0


import pytest


@pytest.mark.parametrize("by_head", [True, False])
def test_parts_sniff_uses_first_line(spark, tmp_path, monkeypatch, by_head):
    from yardstick.sources import heads

    monkeypatch.setattr(heads, "reachable", lambda path: by_head)
    d = str(tmp_path / "p")
    rec = lambda i: json.dumps({"sample": i, "prediction": "no", "batch_path": "o/ds/m/x"})
    _write(f"{d}/a/part-00000.json", [rec(1), rec(2)])
    _write(f"{d}/b/part-00000.json", [json.dumps({"note": "x"}), rec(3)])  # first line is not a parts record
    _write(f"{d}/c/part-00000.json", ["", rec(4)])  # blank first line: not a parts file either
    _write(f"{d}/e/part-00000.json", [json.dumps({"sample": None, "prediction": "no"}), rec(5)])  # keys present
    assert sorted(r.sample for r in scans.discover_parts(spark, d).collect() if r.sample is not None) == [1, 2, 5]
    assert sorted(r.sample for r in scans.discover_parts(spark, d, sniff=False).collect() if r.sample is not None) == [1, 2, 3, 4, 5]


def test_name_data_files(spark, tmp_path):
    from yardstick.sinks import writers

    d = str(tmp_path / "named")
    spark.createDataFrame([("a",), ("b",)], "value string").repartition(2).write.text(d)
    assert writers.name_data_files(spark, d, ".jsonl.out") == len(scans.data_files(spark, d))
    assert all(p.endswith(".jsonl.out") for p in scans.data_files(spark, d))
    assert sorted(r.value for r in scans.raw_output_text(spark, d).collect()) == ["a", "b"]


def test_training_manifest_layouts(spark, tmp_path):
    ref = tmp_path / "train_indices.json"
    ref.write_text(json.dumps({"seed": 42, "samples_per_category": 1, "r": {"accepted": [3]},
                               "all_indices": {"r": [3, 9], "s": [4]}}, indent=2))
    got = sorted(map(tuple, scans.training_manifest(spark, str(ref)).collect()))
    assert got == [("r", 3), ("r", 9), ("s", 4)]
    sampled = spark.createDataFrame([("r", "accepted", 3), ("s", "x", 4)], "split string, category string, sample_id bigint")
    p = str(tmp_path / "ours")
    sampling.manifest_document(sampling.manifest_lists(sampled)).write.json(p)
    assert sorted(map(tuple, scans.training_manifest(spark, p).collect())) == [("r", 3), ("s", 4)]
    assert scans.training_manifest(spark, str(tmp_path / "absent.json")).count() == 0


def test_discovery_under_a_folder_name_with_space_percent_plus(spark, tmp_path):
    d = str(tmp_path / "out put%20+x")
    _write(f"{d}/a.jsonl.out", [_line(1)])
    _write(f"{d}/deeper/b.jsonl.out", [_line(2)])
    got = scans.discover_raw_lines(spark, d).collect()
    assert [json.loads(r.value)["recordId"] for r in got] == ["sample_1"]  # the flat class only
    rec = lambda i: json.dumps({"sample": i, "prediction": "yes", "batch_path": "o/ds/m/x"})
    _write(f"{d}/run 1/part-00000.json", [rec(5)])
    _write(f"{d}/run 2/part-00000.json", [json.dumps({"note": 1}), rec(6)])
    assert sorted(r.sample for r in scans.discover_parts(spark, d).collect()) == [5]


def test_flat_class_read_by_glob_with_glob_characters_in_the_folder(spark, tmp_path):
    d = str(tmp_path / "run[1]{a}")
    _write(f"{d}/a.jsonl.out", [_line(1)])
    _write(f"{d}/nested/b.jsonl.out", [_line(2)])
    got = scans.discover_raw_lines(spark, d).collect()
    assert [json.loads(r.value)["recordId"] for r in got] == ["sample_1"]
    rec = json.dumps({"sample": 3, "prediction": "no", "batch_path": "o/ds/m/x"})
    _write(f"{d}/p.json", [rec])
    _write(f"{d}/metrics.json", [rec])
    assert [r.sample for r in scans.discover_parts(spark, d).collect()] == [3]


def test_flat_class_scan_lists_only_top_level_files(spark, tmp_path):
    d = str(tmp_path / "flat")
    for i in range(3):
        _write(f"{d}/f{i}.jsonl.out", [_line(i)])
        _write(f"{d}/deep/g{i}.jsonl.out", [_line(10 + i)])
    df = scans.discover_raw_lines(spark, d)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryFileIndex(3 paths)" in plan and "/deep/" not in plan  # nested files never listed
    assert not any(ln.strip().startswith(("Filter", "+- Filter", "*(1) Filter")) for ln in plan.splitlines())
    assert sorted(json.loads(r.value)["recordId"] for r in df.collect()) == ["sample_0", "sample_1", "sample_2"]


# --- first records in bounded memory ---------------------------------------------------


def test_keys_of_a_text_that_comes_in_pieces():
    import random

    from yardstick.sources.heads import KeyScanner

    rng = random.Random(4)

    def value(depth):
        kind = rng.randrange(7 if depth < 3 else 4)
        if kind < 4:
            return [rng.random(), None, True, "".join(rng.choice('a"\\{}[]:,é\n\t') for _ in range(rng.randrange(9)))][kind]
        if kind == 4:
            return [value(depth + 1) for _ in range(rng.randrange(4))]
        return {rng.choice(['a', 'b"', "sample", "prédiction", "x{", "y\\", "é:"]): value(depth + 1) for _ in range(rng.randrange(4))}

    for _ in range(400):
        record = {k: value(1) for k in rng.sample(["sample", "prediction", "a", 'b"', "c\\"], rng.randrange(6))}
        data = json.dumps(record, ensure_ascii=rng.random() < 0.5).encode()
        scanner, at = KeyScanner(), 0
        while at < len(data):
            n = rng.randrange(1, 12)
            scanner.feed(data[at : at + n])
            at += n
        assert scanner.ok and scanner.keys == set(record) and scanner.depth == 0
    for bad in (b'["sample"]', b'5', b'x {"sample": 1}', b'"sample"'):
        scanner = KeyScanner()
        scanner.feed(bad)
        assert not scanner.ok


def test_a_file_without_line_breaks_is_not_held(monkeypatch):
    import tracemalloc

    from yardstick.sources import heads

    class Endless:
        """1 GB of one line: keys first or last."""

        def __init__(self, first, last, n=16_000):
            self.left, self.first, self.last, self.n = n, first, last, n

        def read(self, size):
            self.left -= 1
            if self.left == self.n - 1:
                return self.first
            return (b"A" * size) if self.left > 0 else self.last if self.left == 0 else b""

        def __enter__(self):
            return self

        def __exit__(self, *_):
            pass

    class Files:
        def __init__(self, stream):
            self.open_input_stream = lambda inner: stream

    for first, last, want in (
        (b'{"image": "', b'", "sample": 1, "prediction": "yes"}', True),
        (b'{"image": "', b'", "sample": 1}', False),
        (b'{"image": {"sample": 1, "prediction": "', b'"}}', False),
        (b'{"sample": 1, "prediction": "no", "image": "', b'"', True),
        (b'["', b'"]', False),
    ):
        monkeypatch.setattr(heads, "filesystem", lambda path, s=Endless(first, last): (Files(s), path))
        tracemalloc.start()
        assert heads.has_record("x") is want
        assert tracemalloc.get_traced_memory()[1] < 50e6
        tracemalloc.stop()


def test_short_first_lines_are_read_as_the_reference_does(tmp_path):
    from yardstick.sources import heads

    good = '{"sample": 1, "prediction": "yes"}'
    cases = {good + "\nrest": True, good + "\r\nrest": True, " " + good: True, good + " x": False, "": False, "\n" + good: False, '["sample", "prediction"]': True, "7": False, '{"sample": 1}': False}
    for k, (text, want) in enumerate(cases.items()):
        (tmp_path / str(k)).write_bytes(text.encode())
        assert heads.has_record(str(tmp_path / str(k)), chunk=5) is want, text


# --- one listing, checks in tasks, files opened where their rows are ----------------------


def test_both_sides_from_one_listing(spark, tmp_path, monkeypatch):
    from yardstick.plans import jobs

    _write(f"{tmp_path}/a.jsonl.out", [_line(1)])
    _write(f"{tmp_path}/x/part-0.json", [json.dumps({"sample": 2, "prediction": "yes", "batch_path": "o/d/m/x"})])
    assert scans.file_classes(spark, str(tmp_path)) == (0, 1)
    calls = []
    kept = scans.file_classes
    monkeypatch.setattr(scans, "file_classes", lambda *a: calls.append(1) or kept(*a))
    merged, _ = jobs.discovered_predictions(spark, str(tmp_path))
    assert merged.count() == 2 and calls == [1]
    assert kept(spark, str(tmp_path / "x")) == (None, 0)


def test_existence_is_checked_in_tasks_in_order(spark, tmp_path, monkeypatch):
    paths = [str(tmp_path / f"s {k}.parquet") for k in range(300)]
    for p in paths[::3]:
        open(p, "w").close()
    assert scans.existing_paths(spark, paths) == (paths[::3], 200)
    assert scans.existing_paths(spark, ["file:" + paths[0], paths[1]]) == (["file:" + paths[0]], 1)


def test_images_are_opened_where_their_rows_are(spark, tmp_path):
    from pyspark.sql import functions as F

    for k in range(5):
        (tmp_path / f"f{k}.png").write_bytes(bytes([k]) * (k * 1000))
    rows = [(k, None, str(tmp_path / f"f{k}.png")) for k in range(5)]
    rows += [(5, b"own", str(tmp_path / "f1.png")), (6, b"", None), (7, None, ""), (8, None, str(tmp_path / "none.png")), (9, None, str(tmp_path)), (10, None, "weird://x/y")]
    df = spark.createDataFrame([(k, (b, p)) for k, b, p in rows], "k int, image struct<bytes: binary, path: string>").repartition(3)
    out = scans.resolve_images(df, "image")
    got = {r.k: (r.image_bytes, r.image_error) for r in out.collect()}
    for k in range(5):
        assert got[k] == (bytes([k]) * (k * 1000), None)
    assert got[5] == (b"own", None)
    assert all(got[k][0] is None and got[k][1].startswith("Cannot resolve image: ") for k in (6, 7, 8, 9, 10))
    assert got[7][1].endswith("no bytes and no path") and "none.png" in got[8][1]
    plan = scans.resolve_images(df.select("k", "image"), "image").select("k", F.length("image_bytes"))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1  # the repartition of the test itself


def test_contents_come_in_pieces_of_bounded_size(tmp_path):
    from yardstick.sources import heads

    paths = []
    for k, n in enumerate([10, 10, 30, 5, 200, 1, 1]):
        (tmp_path / str(k)).write_bytes(b"x" * n)
        paths.append(str(tmp_path / str(k)))
    paths.insert(3, None)
    sizes = [[len(c) if c is not None else -1 for c, _ in part] for part in heads.contents(paths, in_flight=50)]
    assert sizes == [[10, 10, 30, -1], [5], [200], [1, 1]]
