"""The files that a version of the ledger is made of, with the rows of each by status.

Files lie under ``<root>/data`` and are never changed; versions share those that stay as they are. A
manifest is as long as the ledger has files, whatever its rows.
"""

import json
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from gridledger.versions import read_text, write_text

FILE = "manifest.json"
COUNTS = ("total", "completed", "pending")


@dataclass
class Manifest:
    """``files``: counts of rows by the path under ``data``. ``applied``: the folders of facts whose
    results are in the ledger; None if that isn't known, so that all have to be applied."""

    files: dict[str, dict[str, int]] = field(default_factory=dict)
    applied: list[str] | None = None


def write_manifest(spark: SparkSession, folder: str, manifest: Manifest) -> None:
    lines = [{"applied": manifest.applied}, *({"file": name, **counts} for name, counts in manifest.files.items())]
    write_text(spark, f"{folder}/{FILE}", "".join(json.dumps(line) + "\n" for line in lines))


def read_manifest(spark: SparkSession, version: str) -> Manifest:
    first, *rest = (json.loads(line) for line in read_text(spark, f"{version}/{FILE}").splitlines())
    return Manifest({line.pop("file"): line for line in rest}, first["applied"])
