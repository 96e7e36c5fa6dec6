"""Fixed values.

Lists, tables and constants that results depend on. They are data, stated as they are
published; the logic that uses them is elsewhere in the package.
"""

# --- benchmark names ------------------------------------------------------------------

EXTRA_CLASSIFICATION = [
    "cifar10",
    "cifar100",
    "caltech101",
    "dtd",
    "eurosat",
    "flowers",
    "food101",
    "pets",
    "pcam",
    "resisc45",
]

# Dataset mapping: section, name, web dataset, dataset root, task.
DATASET_MAPPING = [
    ("retrieval_datasets", "mscoco_captions", "wds/mscoco_captions", "https://huggingface.co/datasets/clip-benchmark/wds_mscoco_captions/tree/main", "zeroshot_retrieval"),
    ("retrieval_datasets", "mscoco_captions2017", "wds/mscoco_captions2017", "https://huggingface.co/datasets/clip-benchmark/wds_mscoco_captions2017/tree/main", "zeroshot_retrieval"),
    ("retrieval_datasets", "flickr30k", "wds/flickr30k", "https://huggingface.co/datasets/clip-benchmark/wds_flickr30k/tree/main", "zeroshot_retrieval"),
    ("retrieval_datasets", "flickr8k", "wds/flickr8k", "https://huggingface.co/datasets/clip-benchmark/wds_flickr8k/tree/main", "zeroshot_retrieval"),
    ("classification_datasets", "cars", "wds/cars", "https://huggingface.co/datasets/clip-benchmark/wds_cars/tree/main", "zeroshot_classification"),
    ("classification_datasets", "country211", "wds/country211", "https://huggingface.co/datasets/clip-benchmark/wds_country211/tree/main", "zeroshot_classification"),
    ("classification_datasets", "fgvc_aircraft", "wds/fgvc_aircraft", "https://huggingface.co/datasets/clip-benchmark/wds_fgvc_aircraft/tree/main", "zeroshot_classification"),
    ("classification_datasets", "gtsrb", "wds/gtsrb", "https://huggingface.co/datasets/clip-benchmark/wds_gtsrb/tree/main", "zeroshot_classification"),
    ("classification_datasets", "imagenet1k", "wds/imagenet1k", "https://huggingface.co/datasets/clip-benchmark/wds_imagenet1k/tree/main", "zeroshot_classification"),
    ("classification_datasets", "imagenet-a", "wds/imagenet-a", "https://huggingface.co/datasets/clip-benchmark/wds_imagenet-a/tree/main", "zeroshot_classification"),
    ("classification_datasets", "imagenet-o", "wds/imagenet-o", "https://huggingface.co/datasets/clip-benchmark/wds_imagenet-o/tree/main", "zeroshot_classification"),
    ("classification_datasets", "imagenet-r", "wds/imagenet-r", "https://huggingface.co/datasets/clip-benchmark/wds_imagenet-r/tree/main", "zeroshot_classification"),
    ("classification_datasets", "imagenet_sketch", "wds/imagenet_sketch", "https://huggingface.co/datasets/clip-benchmark/wds_imagenet_sketch/tree/main", "zeroshot_classification"),
    ("classification_datasets", "imagenetv2", "wds/imagenetv2", "https://huggingface.co/datasets/clip-benchmark/wds_imagenetv2/tree/main", "zeroshot_classification"),
    ("classification_datasets", "mnist", "wds/mnist", "https://huggingface.co/datasets/clip-benchmark/wds_mnist/tree/main", "zeroshot_classification"),
    ("classification_datasets", "objectnet", "wds/objectnet", "https://huggingface.co/datasets/clip-benchmark/wds_objectnet/tree/main", "zeroshot_classification"),
    ("classification_datasets", "renderedsst2", "wds/renderedsst2", "https://huggingface.co/datasets/clip-benchmark/wds_renderedsst2/tree/main", "zeroshot_classification"),
    ("classification_datasets", "stl10", "wds/stl10", "https://huggingface.co/datasets/clip-benchmark/wds_stl10/tree/main", "zeroshot_classification"),
    ("classification_datasets", "sun397", "wds/sun397", "https://huggingface.co/datasets/clip-benchmark/wds_sun397/tree/main", "zeroshot_classification"),
    ("classification_datasets", "voc2007", "wds/voc2007", "https://huggingface.co/datasets/clip-benchmark/wds_voc2007/tree/main", "zeroshot_classification"),
    ("classification_datasets", "caltech101", "wds/vtab-caltech101", "https://huggingface.co/datasets/clip-benchmark/wds_vtab-caltech101/tree/main", "zeroshot_classification"),
    ("classification_datasets", "cifar10", "wds/vtab-cifar10", "https://huggingface.co/datasets/clip-benchmark/wds_vtab-cifar10/tree/main", "zeroshot_classification"),
    ("classification_datasets", "cifar100", "wds/vtab-cifar100", "https://huggingface.co/datasets/clip-benchmark/wds_vtab-cifar100/tree/main", "zeroshot_classification"),
    ("classification_datasets", "clevr_closest_object_distance", "wds/vtab-clevr_closest_object_distance", "https://huggingface.co/datasets/clip-benchmark/wds_vtab-clevr_closest_object_distance/tree/main", "zeroshot_classification"),
    ("classification_datasets", "clevr_count_all", "wds/vtab-clevr_count_all", "https://huggingface.co/datasets/clip-benchmark/wds_vtab-clevr_count_all/tree/main", "zeroshot_classification"),
    ("classification_datasets", "dmlab", "wds/vtab-dmlab", "https://huggingface.co/datasets/clip-benchmark/wds_vtab-dmlab/tree/main", "zeroshot_classification"),
    ("classification_datasets", "dsprites_label_orientation", "wds/vtab-dsprites_label_orientation", "https://huggingface.co/datasets/clip-benchmark/wds_vtab-dsprites_label_orientation/tree/main", "zeroshot_classification"),
    ("classification_datasets", "dsprites_label_x_position", "wds/vtab-dsprites_label_x_position", "https://huggingface.co/datasets/clip-benchmark/wds_vtab-dsprites_label_x_position/tree/main", "zeroshot_classification"),
    ("classification_datasets", "dsprites_label_y_position", "wds/vtab-dsprites_label_y_position", "https://huggingface.co/datasets/clip-benchmark/wds_vtab-dsprites_label_y_position/tree/main", "zeroshot_classification"),
    ("classification_datasets", "dtd", "wds/vtab-dtd", "https://huggingface.co/datasets/clip-benchmark/wds_vtab-dtd/tree/main", "zeroshot_classification"),
    ("classification_datasets", "eurosat", "wds/vtab-eurosat", "https://huggingface.co/datasets/clip-benchmark/wds_vtab-eurosat/tree/main", "zeroshot_classification"),
    ("classification_datasets", "flowers", "wds/vtab-flowers", "https://huggingface.co/datasets/clip-benchmark/wds_vtab-flowers/tree/main", "zeroshot_classification"),
    ("classification_datasets", "kitti_closest_vehicle_distance", "wds/vtab-kitti_closest_vehicle_distance", "https://huggingface.co/datasets/clip-benchmark/wds_vtab-kitti_closest_vehicle_distance/tree/main", "zeroshot_classification"),
    ("classification_datasets", "pcam", "wds/vtab-pcam", "https://huggingface.co/datasets/clip-benchmark/wds_vtab-pcam/tree/main", "zeroshot_classification"),
    ("classification_datasets", "pets", "wds/vtab-pets", "https://huggingface.co/datasets/clip-benchmark/wds_vtab-pets/tree/main", "zeroshot_classification"),
    ("classification_datasets", "resisc45", "wds/vtab-resisc45", "https://huggingface.co/datasets/clip-benchmark/wds_vtab-resisc45/tree/main", "zeroshot_classification"),
    ("classification_datasets", "smallnorb_label_azimuth", "wds/vtab-smallnorb_label_azimuth", "https://huggingface.co/datasets/clip-benchmark/wds_vtab-smallnorb_label_azimuth/tree/main", "zeroshot_classification"),
    ("classification_datasets", "smallnorb_label_elevation", "wds/vtab-smallnorb_label_elevation", "https://huggingface.co/datasets/clip-benchmark/wds_vtab-smallnorb_label_elevation/tree/main", "zeroshot_classification"),
    ("classification_datasets", "svhn", "wds/vtab-svhn", "https://huggingface.co/datasets/clip-benchmark/wds_vtab-svhn/tree/main", "zeroshot_classification"),
    ("classification_datasets", "fer2013", "wds/fer2013", "https://huggingface.co/datasets/clip-benchmark/wds_fer2013/tree/main", "zeroshot_classification"),
    ("classification_datasets", "diabetic_retinopathy", "wds/vtab-diabetic_retinopathy", "https://huggingface.co/datasets/clip-benchmark/wds_vtab-diabetic_retinopathy/tree/main", "zeroshot_classification"),
    ("classification_datasets", "voc2007_multilabel", "wds/voc2007_multilabel", "https://huggingface.co/datasets/clip-benchmark/wds_voc2007_multilabel/tree/main", "zeroshot_classification"),
    ("classification_datasets", "food101", "wds/food101", "https://huggingface.co/datasets/clip-benchmark/wds_food101/tree/main", "zeroshot_classification"),
    ("classification_datasets", "sun397_official_splits", "wds/sun397_official_splits", "https://huggingface.co/datasets/clip-benchmark/wds_sun397_official_splits/tree/main", "zeroshot_classification"),
]

# --- result file names ----------------------------------------------------------------

KNOWN_PRETRAINED = ["openai", "laion2b_s34b_b79k", "laion400m_e31", "laion400m_e32"]
MODEL_STOP_WORDS = ["en", "zeroshot", "classification", "retrieval"]

# --- model metadata -------------------------------------------------------------------

# model, GPU memory GB, parameters in millions, recommended GPU, batch size hint, family
MODEL_METADATA = [
    ("ViT-B-32", 4, 88, "T4", 512, "ViT-Base"),
    ("ViT-B-16", 6, 86, "T4", 256, "ViT-Base"),
    ("ViT-L-14", 12, 304, "V100", 128, "ViT-Large"),
    ("ViT-L-14-336", 16, 304, "A100", 64, "ViT-Large"),
    ("ViT-H-14", 24, 632, "A100", 32, "ViT-Huge"),
    ("ViT-g-14", 32, 1012, "A100-80GB", 16, "ViT-Giant"),
    ("ViT-G-14", 32, 1012, "A100-80GB", 16, "ViT-Giant"),
    ("RN50", 3, 38, "T4", 512, "ResNet"),
    ("RN101", 4, 57, "T4", 384, "ResNet"),
    ("RN50x4", 8, 87, "V100", 256, "ResNet"),
    ("RN50x16", 16, 168, "A100", 128, "ResNet"),
    ("RN50x64", 32, 623, "A100-80GB", 64, "ResNet"),
    ("convnext_base", 8, 89, "V100", 256, "ConvNeXT"),
    ("convnext_base_w", 8, 89, "V100", 256, "ConvNeXT"),
    ("convnext_base_w_320", 12, 89, "V100", 128, "ConvNeXT"),
    ("convnext_large_d", 16, 198, "A100", 128, "ConvNeXT"),
    ("convnext_large_d_320", 20, 198, "A100", 64, "ConvNeXT"),
    ("convnext_xxlarge", 40, 846, "A100-80GB", 32, "ConvNeXT"),
    ("EVA01-g-14", 32, 1012, "A100-80GB", 16, "EVA"),
    ("EVA01-g-14-plus", 40, 1012, "A100-80GB", 16, "EVA"),
    ("EVA02-B-16", 8, 86, "V100", 256, "EVA"),
    ("EVA02-L-14", 16, 304, "A100", 64, "EVA"),
    ("EVA02-L-14-336", 20, 304, "A100", 32, "EVA"),
]

# For other models: the first row with a substring in the name; the last row is the default.
# substrings, GPU memory GB, parameters in millions, recommended GPU, batch size hint, family
MODEL_FALLBACKS = [
    (["ViT-g-", "ViT-G-", "EVA01-g-"], 32, 1000, "A100-80GB", 16, "Unknown-Giant"),
    (["ViT-H-", "xxlarge"], 24, 600, "A100", 32, "Unknown-Huge"),
    (["ViT-L-", "large", "EVA02-L-"], 12, 300, "V100", 128, "Unknown-Large"),
    (["ViT-B-", "base", "EVA02-B-"], 6, 90, "T4", 256, "Unknown-Base"),
    ([], 8, 100, "V100", 128, "Unknown"),
]

# --- run time and cost ----------------------------------------------------------------

BASE_MINUTES = 20
FAMILY_FACTORS = {"Giant": 3.0, "Huge": 2.5, "Large": 2.0, "Base": 1.0}
OTHER_FAMILY_FACTOR = 1.5
RETRIEVAL_FACTOR = 1.5
DATASET_FACTORS = {
    "imagenet1k": 2.0,
    "mscoco_captions": 1.8,
    "flickr30k": 1.2,
    "cifar10": 0.3,
    "cifar100": 0.4,
    "caltech101": 0.5,
    "dtd": 0.4,
    "eurosat": 0.3,
    "flowers": 0.3,
    "food101": 1.0,
    "pets": 0.4,
    "pcam": 0.8,
    "resisc45": 0.6,
}
MIN_MINUTES = 10
MAX_MINUTES = 180
PLANNED_MINUTES_PER_BENCHMARK = 2

GPU_HOURLY_RATES = {"A100:1": 3.0, "V100:1": 2.0, "T4:1": 0.5}
DEFAULT_HOURLY_RATE = 2.0
SPOT_FACTOR = 0.3
GPUS_PER_NODE = 8
