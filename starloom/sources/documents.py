"""Document collections.

A collection is a set of JSON-lines folders below ``location``, or, when the caller ships a
connector, whatever its ``format`` makes of a database (``location``) and a collection name.

A ledger beside the folders tells which of them are live. Every change writes its documents to
folders of their own and then one small file, the next state of the ledger, so that readers meet
all of a change or nothing, over several collections too, and a failure leaves the former state.
A plain directory of JSON lines that the ledger does not name is a collection as well.
Writers of one ``location`` take turns.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.names import column
from starloom.scratch import drop_folder, scratch_path
from starloom.sources.json import read_json_array

ID = "_id"
#: The folder below a location that tells which folders are live.
LEDGER = "ledger.of.collections"


def _address(location: str, name: str) -> dict[str, str]:
    return {"database": location, "collection": name}


def read_collection(
    spark: SparkSession,
    location: str,
    name: str,
    where: Mapping[str, object] | None = None,
    drop_id: bool = True,
    format: str = "json",
    options: Mapping[str, str] | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Documents whose fields equal those of ``where``; no ``where`` matches all.

    A None in ``where`` matches a null or absent field.
    """
    reader = spark.read.format(format).options(**(options or {}))
    reader = reader if schema is None else reader.schema(schema)
    if format == "json":
        ledger = _Ledger(spark, location)
        documents = reader.load(ledger.folders(name) or [ledger.place(name)])
    else:
        documents = reader.options(**_address(location, name)).load()
    for field, value in (where or {}).items():
        documents = documents.where(column(field).eqNullSafe(F.lit(value)))
    return documents.drop(ID) if drop_id else documents


class _Ledger:
    """The live folders of the collections below a place."""

    fields = "number bigint, state string, name string, folder string, token string"

    def __init__(self, spark: SparkSession, location: str) -> None:
        self._spark, self._base = spark, location.rstrip("/")
        self._path = f"{self._base}/{LEDGER}"
        try:
            reader = spark.read.schema(self.fields).option("recursiveFileLookup", True)
            # The last states only, a line for each live folder.
            self._rows = reader.json(self._path).collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            self._rows = []
        self._number = max((row.number for row in self._rows), default=0)
        self.live = [row for row in self._rows if row.number == self._number and row.folder]

    def folders(self, name: str) -> list[str]:
        return [f"{self._base}/{row.folder}" for row in self.live if row.name == name]

    def tokens(self, name: str) -> set[str]:
        return {row.token for row in self.live if row.name == name and row.token}

    def new_folder(self, name: str) -> str:
        return f"{name}.batches/batch-{uuid.uuid4().hex}"

    def place(self, folder: str) -> str:
        return f"{self._base}/{folder}"

    def commit(self, live: list[tuple[str, str, str | None]]) -> None:
        """Make ``name, folder, token`` the live folders, by one file.

        Folders that neither this state nor the one before names are deleted afterwards.
        """
        number, state = self._number + 1, uuid.uuid4().hex
        rows = [(number, state, *row) for row in live] or [(number, state, "", "", None)]
        frame = self._spark.createDataFrame(rows, self.fields).coalesce(1)
        frame.write.json(f"{self._path}/state-{number}-{state}")
        kept = {folder for _, folder, _ in live} | {row.folder for row in self.live}
        former = [row for row in self._rows if row.number < self._number]
        # Only folders that the ledger made; a plain directory is the user's.
        gone = {row.folder for row in former if row.folder and "/" in row.folder} - kept
        states = {f"{LEDGER}/state-{row.number}-{row.state}" for row in former}
        for folder in [*sorted(gone), *sorted(states)]:
            drop_folder(self._spark, f"{self._base}/{folder}")


def _identified(documents: DataFrame) -> DataFrame:
    if ID in documents.columns:
        return documents
    return documents.select(F.expr("uuid()").alias(ID), "*")


def _write_lines(documents: DataFrame, place: str) -> int:
    counted = Observation()
    observed = _identified(documents).observe(counted, F.count(F.lit(1)).alias("n"))
    observed.write.option("ignoreNullFields", False).json(place)
    return counted.get["n"]


def _write(
    documents: DataFrame,
    location: str,
    name: str,
    mode: str,
    format: str,
    options: Mapping[str, str] | None,
) -> int:
    counted = Observation()
    observed = _identified(documents).observe(counted, F.count(F.lit(1)).alias("n"))
    writer = observed.write.format(format).options(**_address(location, name))
    writer.options(**(options or {})).mode(mode).save()
    return counted.get["n"]


def append_documents(
    documents: DataFrame,
    location: str,
    name: str,
    format: str = "json",
    options: Mapping[str, str] | None = None,
    token: str | None = None,
) -> int:
    """Add documents to a collection and return how many.

    A rerun adds them again, unless it has the ``token`` of an upload that is in: the ledger
    notes it in the same step that makes the documents live, so that an upload that is repeated,
    after a crash at any point too, adds nothing twice. Connectors take no token.
    """
    if format != "json":
        if token is not None:
            raise ValueError("a connector takes no token")
        return _write(documents, location, name, "append", format, options)
    if name == LEDGER:
        raise ValueError(f"the name of the ledger: {name}")
    spark = documents.sparkSession
    ledger = _Ledger(spark, location)
    if token is not None and token in ledger.tokens(name):
        return 0
    held = [(row.name, row.folder, row.token) for row in ledger.live]
    if not ledger.folders(name) and _is_there(spark, ledger.place(name)):
        held.append((name, name, None))
    folder = ledger.new_folder(name)
    try:
        count = _write_lines(documents, ledger.place(folder))
        ledger.commit([*held, (name, folder, token)])
    except Exception:
        if ledger.place(folder) not in _Ledger(spark, location).folders(name):
            drop_folder(spark, ledger.place(folder))
        raise
    return count


def _is_there(spark: SparkSession, path: str) -> bool:
    try:
        return bool(spark.read.text(path).take(1))
    except AnalysisException:
        return False


def replace_collections(
    spark: SparkSession,
    location: str,
    files: Mapping[str, str],
    format: str = "json",
    options: Mapping[str, str] | None = None,
    schemas: Mapping[str, T.StructType | str] | None = None,
) -> dict[str, int]:
    """Make every collection hold exactly its JSON-array files; return the sizes.

    All files are parsed and written first, and one step makes all of it live, so whatever fails
    leaves every collection as it was. A connector is handed the collections one by one, parsed
    in full before; what it does when it fails is its own.
    """
    if format != "json":
        return _replace_elsewhere(spark, location, files, format, options, schemas)
    if LEDGER in files:
        raise ValueError(f"the name of the ledger: {LEDGER}")
    ledger = _Ledger(spark, location)
    folders = {name: ledger.new_folder(name) for name in files}
    try:
        sizes = {
            name: _write_lines(
                read_json_array(spark, path, (schemas or {}).get(name)), ledger.place(folders[name])
            )
            for name, path in files.items()
        }
        others = [(row.name, row.folder, row.token) for row in ledger.live if row.name not in files]
        ledger.commit([*others, *((name, folder, None) for name, folder in folders.items())])
    except Exception:
        now = _Ledger(spark, location)
        for name, folder in folders.items():
            if ledger.place(folder) not in now.folders(name):
                drop_folder(spark, ledger.place(folder))
        raise
    return sizes


def _replace_elsewhere(spark, location, files, format, options, schemas) -> dict[str, int]:
    staged: dict[str, DataFrame] = {}
    base = scratch_path(spark, "documents")
    try:
        for name, path in files.items():
            documents = read_json_array(spark, path, (schemas or {}).get(name))
            place = f"{base}/{len(staged)}"
            documents.write.option("ignoreNullFields", False).json(place)
            staged[name] = spark.read.schema(documents.schema).json(place)
        return {
            name: _write(documents, location, name, "overwrite", format, options)
            for name, documents in staged.items()
        }
    finally:
        drop_folder(spark, base)
