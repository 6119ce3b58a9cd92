"""Several outputs of a micro-batch that become visible together.

Every attempt at a batch writes its outputs into folders of its own,

    <root>/<output>/batch_id=<n>/attempt=<id>/

and then names itself in ``<root>/manifest/<n>`` by one rename. Readers take only rows of named
attempts, so they see all outputs of a batch or none; rows of an attempt that failed half-way are
in no result. A batch that is named already is not written again when it is repeated (the process
stopped between the manifest and the query's own commit). Values that belong to the batch, such
as its time, are part of the manifest: a repeat that does write takes those of the first attempt
from ``<root>/begun/<n>``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .batches import delete_folder, exists
from .once import names, read_text, write_once

Outputs = Mapping[str, DataFrame]


class Manifest:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root

    def _named(self, batch_id: int) -> str:
        return f"{self.root}/manifest/{int(batch_id)}"

    def committed(self, batch_id: int) -> bool:
        return read_text(self.spark, self._named(batch_id)) is not None

    def begin(self, batch_id: int, value: str) -> str:
        """A value of the batch (its time): that of the first attempt, whoever asks."""
        return write_once(self.spark, f"{self.root}/begun/{int(batch_id)}", value)

    def write(self, batch_id: int, outputs: Callable[[], Outputs], value: str = "",
              written: Callable[[str], None] = lambda name: None) -> bool:
        """Write the outputs of a batch and name them; False if the batch was named before. ``outputs`` is called only
        when they are to be written; ``written`` is told each output's name after it is written."""
        if self.committed(batch_id):
            return False
        attempt = uuid.uuid4().hex[:12]
        for name, df in outputs().items():
            df.write.parquet(f"{self.root}/{name}/batch_id={int(batch_id)}/attempt={attempt}")
            written(name)
        entry = json.dumps({"batch_id": int(batch_id), "attempt": attempt, "value": value})
        kept = json.loads(write_once(self.spark, self._named(batch_id), entry))
        return kept["attempt"] == attempt

    def entries(self) -> DataFrame:
        """batch_id, attempt, value of the named batches."""
        schema = "batch_id bigint, attempt string, value string"
        if not exists(self.spark, f"{self.root}/manifest"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).json(f"{self.root}/manifest")

    def read(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        """The rows of an output in all named batches, with ``batch_id``; the schema is that of the files if not
        given. The join with the manifest (a row a batch) leaves out other attempts."""
        path = f"{self.root}/{name}"
        if schema is None:
            schema = self.spark.read.option("recursiveFileLookup", "true").parquet(path).schema
        full = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType()), T.StructField("attempt", T.StringType())])
        rows = self.spark.read.schema(full).parquet(path)
        return rows.join(self.entries().select("batch_id", "attempt"), ["batch_id", "attempt"], "left_semi").drop("attempt")

    def clean(self) -> None:
        """Remove the folders of attempts that were not named, of named batches only (others may be running)."""
        for name in names(self.spark, self.root):
            if name in ("manifest", "begun"):
                continue
            for folder in names(self.spark, f"{self.root}/{name}", "batch_id="):
                text = read_text(self.spark, self._named(int(folder.split("=")[1])))
                if text is not None:
                    for attempt in names(self.spark, f"{self.root}/{name}/{folder}", "attempt="):
                        if attempt != f"attempt={json.loads(text)['attempt']}":
                            delete_folder(self.spark, f"{self.root}/{name}/{folder}/{attempt}")
