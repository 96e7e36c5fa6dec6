import json

from conftest import plan, rows
from pyspark.sql import functions as F

from gridledger import fixed
from gridledger.operators import catalog
from gridledger.sources.mapping import read_dataset_mapping, read_model_catalog


HUB = "https://huggingface.co/datasets/clip-benchmark/"

# Section, name and web dataset of each entry.
MAPPING = """
retrieval mscoco_captions wds/mscoco_captions
retrieval mscoco_captions2017 wds/mscoco_captions2017
retrieval flickr30k wds/flickr30k
retrieval flickr8k wds/flickr8k
classification cars wds/cars
classification country211 wds/country211
classification fgvc_aircraft wds/fgvc_aircraft
classification gtsrb wds/gtsrb
classification imagenet1k wds/imagenet1k
classification imagenet-a wds/imagenet-a
classification imagenet-o wds/imagenet-o
classification imagenet-r wds/imagenet-r
classification imagenet_sketch wds/imagenet_sketch
classification imagenetv2 wds/imagenetv2
classification mnist wds/mnist
classification objectnet wds/objectnet
classification renderedsst2 wds/renderedsst2
classification stl10 wds/stl10
classification sun397 wds/sun397
classification voc2007 wds/voc2007
classification caltech101 wds/vtab-caltech101
classification cifar10 wds/vtab-cifar10
classification cifar100 wds/vtab-cifar100
classification clevr_closest_object_distance wds/vtab-clevr_closest_object_distance
classification clevr_count_all wds/vtab-clevr_count_all
classification dmlab wds/vtab-dmlab
classification dsprites_label_orientation wds/vtab-dsprites_label_orientation
classification dsprites_label_x_position wds/vtab-dsprites_label_x_position
classification dsprites_label_y_position wds/vtab-dsprites_label_y_position
classification dtd wds/vtab-dtd
classification eurosat wds/vtab-eurosat
classification flowers wds/vtab-flowers
classification kitti_closest_vehicle_distance wds/vtab-kitti_closest_vehicle_distance
classification pcam wds/vtab-pcam
classification pets wds/vtab-pets
classification resisc45 wds/vtab-resisc45
classification smallnorb_label_azimuth wds/vtab-smallnorb_label_azimuth
classification smallnorb_label_elevation wds/vtab-smallnorb_label_elevation
classification svhn wds/vtab-svhn
classification fer2013 wds/fer2013
classification diabetic_retinopathy wds/vtab-diabetic_retinopathy
classification voc2007_multilabel wds/voc2007_multilabel
classification food101 wds/food101
classification sun397_official_splits wds/sun397_official_splits
"""


def test_default_mapping(spark):
    expected = set()
    for section, name, web in map(str.split, MAPPING.strip().split("\n")):
        root = f"{HUB}{web.replace('/', '_')}/tree/main"
        expected.add((f"{section}_datasets", name, web, root, f"zeroshot_{section}"))
    found = catalog.default_mapping(spark).collect()
    assert set(map(tuple, found)) == expected and len(found) == len(expected) == 44


def test_mapping_file_of_many_lines(spark, tmp_path):
    entry = {"webdataset_name": "w", "dataset_root": "r", "task": "t"}
    path = tmp_path / "mapping.json"
    path.write_text(json.dumps({"retrieval_datasets": {"a": entry}, "classification_datasets": {"b": entry, "c": entry}}, indent=2))
    assert rows(read_dataset_mapping(spark, str(path))) == [
        ("classification_datasets", "b", "w", "r", "t"),
        ("classification_datasets", "c", "w", "r", "t"),
        ("retrieval_datasets", "a", "w", "r", "t"),
    ]


def test_benchmark_catalog(spark):
    base = spark.createDataFrame([("svhn",), ("pets",), ("svhn",)], "benchmark string")
    found = rows(catalog.benchmark_catalog(base, catalog.default_mapping(spark)))
    assert [b for t, b in found if t == "zeroshot_classification"] == sorted({"svhn", *fixed.EXTRA_CLASSIFICATION})
    assert {b for t, b in found if t == "zeroshot_retrieval"} == {"mscoco_captions", "mscoco_captions2017", "flickr30k", "flickr8k"}


def test_dataset_config(spark):
    asked = [("zeroshot_retrieval", "flickr8k"), ("zeroshot_classification", "flickr8k"), ("other", "pets"), ("zeroshot_retrieval", "pets")]
    df = spark.createDataFrame(asked, "task_type string, benchmark string")
    found = {(r[0], r[1]): tuple(r[2:]) for r in catalog.with_dataset_config(df, catalog.default_mapping(spark)).collect()}
    hub = HUB
    assert found == {
        asked[0]: ("wds/flickr8k", f"{hub}wds_flickr8k/tree/main", "zeroshot_retrieval"),
        asked[1]: ("flickr8k", "root", "zeroshot_classification"),
        asked[2]: ("wds/vtab-pets", f"{hub}wds_vtab-pets/tree/main", "zeroshot_classification"),
        asked[3]: ("pets", "root", "zeroshot_retrieval"),
    }


def test_grid_by_blocks_equals_grid_sent_whole(spark, monkeypatch):
    models = spark.range(40).select(F.concat(F.lit("m"), "id").alias("model"), F.lit("w").alias("pretrained"))
    benchmarks = spark.range(57).select(F.lit("t").alias("task_type"), F.concat(F.lit("b"), "id").alias("benchmark"))
    whole = catalog.pair_grid(models, benchmarks)
    assert "BroadcastNestedLoopJoin BuildRight, Cross" in plan(whole)
    monkeypatch.setattr(catalog, "row_bound", lambda df: False)
    monkeypatch.setattr(catalog, "CATALOG_BLOCK", 10)
    parts = catalog.pair_grid(models, benchmarks)
    assert rows(parts) == rows(whole) and parts.count() == 40 * 57


def test_model_catalog(spark, tmp_path):
    (tmp_path / "models.csv").write_text("model,pretrained\na,x\na,y\na,x\n")
    assert rows(catalog.model_catalog(read_model_catalog(spark, str(tmp_path / "models.csv")))) == [("a", "x"), ("a", "y")]


def test_mapping_needs_no_shuffle_of_the_rows(spark):
    df = spark.range(100).select(F.lit("zeroshot_classification").alias("task_type"), F.concat(F.lit("b"), "id").alias("benchmark"))
    text = plan(catalog.with_dataset_config(df, catalog.default_mapping(spark)))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text
