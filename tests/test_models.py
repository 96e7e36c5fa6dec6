import pytest
from pyspark.sql import functions as F

from gridledger.functions.models import gpu_cost, one_gpu, runtime_minutes, with_requirement

C, R = "zeroshot_classification", "zeroshot_retrieval"


# Model, memory in GB, parameters in millions, GPU, batch size and family of the known models.
METADATA = """
ViT-B-32 4 88 T4 512 ViT-Base
ViT-B-16 6 86 T4 256 ViT-Base
ViT-L-14 12 304 V100 128 ViT-Large
ViT-L-14-336 16 304 A100 64 ViT-Large
ViT-H-14 24 632 A100 32 ViT-Huge
ViT-g-14 32 1012 A100-80GB 16 ViT-Giant
ViT-G-14 32 1012 A100-80GB 16 ViT-Giant
RN50 3 38 T4 512 ResNet
RN101 4 57 T4 384 ResNet
RN50x4 8 87 V100 256 ResNet
RN50x16 16 168 A100 128 ResNet
RN50x64 32 623 A100-80GB 64 ResNet
convnext_base 8 89 V100 256 ConvNeXT
convnext_base_w 8 89 V100 256 ConvNeXT
convnext_base_w_320 12 89 V100 128 ConvNeXT
convnext_large_d 16 198 A100 128 ConvNeXT
convnext_large_d_320 20 198 A100 64 ConvNeXT
convnext_xxlarge 40 846 A100-80GB 32 ConvNeXT
EVA01-g-14 32 1012 A100-80GB 16 EVA
EVA01-g-14-plus 40 1012 A100-80GB 16 EVA
EVA02-B-16 8 86 V100 256 EVA
EVA02-L-14 16 304 A100 64 EVA
EVA02-L-14-336 20 304 A100 32 EVA
"""


def test_requirements(spark):
    expected = {
        "ViT-B-32": (4, 88, "T4", 512, "ViT-Base"),
        "ViT-L-14": (12, 304, "V100", 128, "ViT-Large"),
        "EVA01-g-14": (32, 1012, "A100-80GB", 16, "EVA"),
        "ViT-B-32-quickgelu": (6, 90, "T4", 256, "Unknown-Base"),
        "EVA01-g-99": (32, 1000, "A100-80GB", 16, "Unknown-Giant"),
        "xlm-roberta-large-ViT-H-14": (24, 600, "A100", 32, "Unknown-Huge"),
        "convnext_large": (12, 300, "V100", 128, "Unknown-Large"),
        "EVA02-E-14": (8, 100, "V100", 128, "Unknown"),
        "vit-b-32": (8, 100, "V100", 128, "Unknown"),
    }
    known = [line.split() for line in METADATA.strip().split("\n")]
    assert len(known) == 23
    expected |= {name: (int(gb), int(size), gpu, int(batch), family) for name, gb, size, gpu, batch, family in known}
    df = spark.createDataFrame([(m,) for m in expected], "model string")
    assert {r[0]: tuple(r[1:]) for r in with_requirement(df).collect()} == expected


@pytest.mark.parametrize(
    "model, task, benchmark, minutes",
    [
        ("ViT-B-32", C, "cifar10", 10),
        ("ViT-B-32", C, "unlisted", 20),
        ("ViT-L-14", C, "imagenet1k", 80),
        ("ViT-g-14", R, "mscoco_captions", 162),
        ("ViT-G-14", R, "imagenet1k", 180),
        ("RN50", R, "cifar10", 13),
        ("ViT-H-14", R, "cifar10", 22),
        ("ViT-H-14", R, "caltech101", 37),
        ("EVA01-g-99", C, "unlisted", 60),
        ("EVA01-g-14", C, "unlisted", 30),
    ],
)
def test_runtime(spark, model, task, benchmark, minutes):
    df = spark.createDataFrame([(model, task, benchmark)], "model string, task_type string, benchmark string")
    assert with_requirement(df).select(runtime_minutes()).first()[0] == minutes


@pytest.mark.parametrize(
    "gpu, hours, spot, cost",
    [
        ("A100:1", 2.0, True, 1.7999999999999998),
        ("V100:1", 1.5, True, 0.8999999999999999),
        ("T4:1", 4.0, False, 2.0),
        ("H100:1", 1.0, False, 2.0),
        ("A100", 1.0, False, 2.0),
    ],
)
def test_cost(spark, gpu, hours, spot, cost):
    df = spark.createDataFrame([(gpu, hours)], "gpu string, hours double")
    assert df.select(gpu_cost("gpu", "hours", spot)).first()[0] == cost


def test_rate_of_a_recommended_gpu(spark):
    df = spark.createDataFrame([("T4",)], "recommended_gpu string")
    assert df.select(gpu_cost(one_gpu(), F.lit(1.0), False)).first()[0] == 0.5
