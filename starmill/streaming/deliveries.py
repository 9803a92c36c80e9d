"""Load files as they arrive: new ones as an available-now stream, corrected ones by a ledger."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from starmill.sources.delimited import SOURCE_PATH, parse_lines, read_delimited, read_lines
from starmill.sources.ledger import FileLedger, readable_path
from starmill.sources.scratch import written

Load = Callable[[DataFrame, Sequence[str]], None]


def _stream(
    spark: SparkSession,
    folder: str,
    each: Callable[[DataFrame], None],
    checkpoint: str,
    encoding: str,
) -> None:
    query = (
        read_lines(spark.readStream, folder, encoding)
        .writeStream.foreachBatch(lambda lines, _: each(lines))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def load_new_files(
    spark: SparkSession,
    folder: str,
    columns: Mapping[str, str],
    load: Callable[[DataFrame], None],
    checkpoint: str,
    *,
    sep: str = ";",
    encoding: str = "UTF-8",
    ragged: str = "fail",
) -> None:
    """Hand each batch of new files to ``load``, then return.

    Each file is read by its own header. The stream's checkpoint remembers which files were
    loaded; a file corrected under its path is not read again (see ``load_arrived_files``).
    ``load`` is the batch function, and it replaces whole deliveries, so a batch that is
    retried after a failure, or files read again under a new checkpoint, leave one copy. The
    files of one folder may come in several runs, so ``load`` takes the file
    (``source_path``) as the delivery, not its folder.
    """
    _stream(
        spark, folder, lambda lines: load(parse_lines(lines, columns, sep=sep, ragged=ragged)),
        checkpoint, encoding,
    )


def load_changed_files(
    spark: SparkSession,
    folder: str,
    columns: Mapping[str, str],
    load: Load,
    ledger: FileLedger,
    *,
    sep: str = ";",
    encoding: str = "UTF-8",
    ragged: str = "fail",
) -> list[str]:
    """Hand the files that the ledger does not know in their present state to ``load``.

    These are new and corrected files. ``load`` gets their rows and their names: stored rows of
    a named file that has none left must go. The files are noted as loaded afterwards, so
    that a failed load is repeated. Returns their names; a listing is all that is read
    where nothing changed.
    """
    files = written(ledger.unloaded(folder), "changed-files")
    names = [r[0] for r in files.select(SOURCE_PATH).collect()]  # one row per changed file
    if names:
        paths = [readable_path(name) for name in names]
        load(read_delimited(spark, paths, columns, sep=sep, encoding=encoding, ragged=ragged), names)
        ledger.record(files)
    return names


def load_arrived_files(
    spark: SparkSession,
    folder: str,
    columns: Mapping[str, str],
    load: Load,
    checkpoint: str,
    ledger: FileLedger,
    *,
    sep: str = ";",
    encoding: str = "UTF-8",
    ragged: str = "fail",
) -> list[str]:
    """Hand new files to ``load`` as a stream, then those that were corrected under their path.

    The stream notes in the ledger what it loaded, so a file that changes later differs from
    its entry. New files without a single row come with the corrected ones. Returns the
    names of the files of the second step.
    """

    def each(lines: DataFrame) -> None:
        names = [r[0] for r in lines.select(SOURCE_PATH).distinct().collect()]  # one row per file
        if names:
            load(parse_lines(lines, columns, sep=sep, ragged=ragged), names)
            ledger.record(lines)

    _stream(spark, folder, each, checkpoint, encoding)
    return load_changed_files(
        spark, folder, columns, load, ledger, sep=sep, encoding=encoding, ragged=ragged
    )
