"""Publishing several partitioned tables in one step.

Tables that belong together are first written whole to a staging folder beside
the live ones. Only when every write has ended are their month directories
moved into place; a month that is replaced is set aside until all moves are
done. If a write fails, nothing live was touched; if a move fails, the moves
made so far are taken back. Months that the run did not write stay as they are
(the same rule as dynamic partition overwrite).

A move is a rename: atomic per directory where the file system renames, a copy
on object stores that only emulate it. Readers may see some months of the new
run before others while the moves run, but never a table without a month.
The moves are one pair of renames per written directory on the driver, at most
one per table and month.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from tierlake.sources.storage import Storage


def staging_folder(target_uri: str) -> str:
    """A new folder for one run; the leading underscore hides it from table scans."""
    return f"{target_uri.rstrip('/')}/_staging-{uuid.uuid4().hex}"


def month_folders(storage: Storage, table_uri: str) -> list[str]:
    """``year=Y/month=M`` below a table's folder."""
    out = []
    for year, is_dir in storage.children(table_uri):
        if is_dir and year.startswith("year="):
            out += [f"{year}/{month}" for month, sub in storage.children(f"{table_uri}/{year}") if sub and month.startswith("month=")]
    return out


def publish(spark: SparkSession, staging_uri: str, target_uri: str, tables: list[str]) -> int:
    """Move every staged month of ``tables`` from ``staging_uri/<table>`` to ``target_uri/<table>``; returns
    their number. Either all of them are live afterwards, or none and the error is raised; the staging folder
    is deleted in both cases. Only if taking moves back fails as well does it stay, with the replaced months."""
    storage = Storage(spark)
    target = target_uri.rstrip("/")
    moves = [f"{t}/{m}" for t in tables for m in month_folders(storage, f"{staging_uri}/{t}")]
    done: list[tuple[str, str]] = []

    def move(source: str, to: str) -> None:
        storage.move(source, to)
        done.append((source, to))

    try:
        for m in moves:
            if storage.exists(f"{target}/{m}"):
                move(f"{target}/{m}", f"{staging_uri}/_replaced/{m}")
            move(f"{staging_uri}/{m}", f"{target}/{m}")
    except Exception:
        try:
            for source, to in reversed(done):
                storage.move(to, source)
        except Exception as exc:
            raise RuntimeError(f"{target} is partly published; its replaced months are in {staging_uri}/_replaced") from exc
        storage.delete(staging_uri)
        raise
    storage.delete(staging_uri)
    return len(moves)
