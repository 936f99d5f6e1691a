"""Running a user's command over the lines of every piece or partition."""

from __future__ import annotations

import subprocess
import threading
from collections.abc import Iterator, Sequence
from itertools import groupby
from operator import itemgetter

import pandas as pd
from pyspark.sql import DataFrame

LINES_PER_BATCH = 10_000


def pipe_partitions(df: DataFrame, argv: Sequence[str], row: str = "row") -> DataFrame:
    """Feed ``row`` lines to ``argv`` and return its output lines.

    Placed rows (with ``part_id`` and ``piece``) have one command per piece, and the result carries both
    columns: an answer per region is put together from those of its pieces, whatever their tasks. A region
    without rows has no piece and no command. Other rows have one command per partition.

    Input and output are streamed; a piece is never held in memory. A non-zero exit code fails the task.
    The list is run as it is, without a shell.
    """
    if isinstance(argv, str):
        raise ValueError("argv must be a list of arguments, not a shell string")
    command = list(argv)
    keys = ["part_id", "piece"] if {"part_id", "piece"} <= set(df.columns) else []

    def chunks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[tuple, pd.Series]]:
        for batch in batches:
            if keys:
                for key, rows in batch.groupby(keys, sort=False):
                    yield key, rows[row]
            else:
                yield (), batch[row]

    def one(key: tuple, lines: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        process = subprocess.Popen(command, stdin=subprocess.PIPE, stdout=subprocess.PIPE)
        failure: list[BaseException] = []

        def feed() -> None:
            try:
                with process.stdin as sink:
                    for some in lines:
                        sink.writelines(f"{line}\n".encode() for line in some)
            except BrokenPipeError:
                pass  # the command stopped reading early; its exit code decides
            except BaseException as error:
                failure.append(error)
                process.kill()

        def result(found: list[str]) -> pd.DataFrame:
            return pd.DataFrame(dict(zip(keys, key, strict=True)) | {row: found})

        feeder = threading.Thread(target=feed, daemon=True)
        feeder.start()
        pending: list[str] = []
        try:
            # A binary stream ends lines at the line feed only, so a carriage return stays in its line.
            for line in process.stdout:
                pending.append(line.removesuffix(b"\n").decode())
                if len(pending) == LINES_PER_BATCH:
                    yield result(pending)
                    pending = []
            code = process.wait()
            feeder.join()
            if failure:
                raise failure[0]
            if code:
                raise RuntimeError(f"{command[0]} ended with exit code {code}")
            if pending:
                yield result(pending)
        finally:
            # Reached early when the rows are no longer wanted or the task fails.
            if process.poll() is None:
                process.kill()
                process.wait()
            process.stdout.close()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Rows of a piece stand together; what a command leaves unread of its piece is skipped.
        for key, group in groupby(chunks(batches), itemgetter(0)):
            yield from one(key, (lines for _, lines in group))

    kinds = "".join(f"`{k}` {df.schema[k].dataType.simpleString()}, " for k in keys)
    return df.select(*keys, row).mapInPandas(run, f"{kinds}`{row}` string")
