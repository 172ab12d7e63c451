"""All-or-nothing writes of several stored tables (K6), on any file system with
an atomic rename and without a table format.

A batch writes every table's files under ``<root>/_staging/<batch>``. When all
are there, one list of the file moves and deletions that publish them is put
under ``<root>/_commits`` by a rename: that is the commit. The moves follow, and
the list goes last. ``recover`` carries out the lists it finds; every read of a
stored table calls it first, so readers see a batch in all tables or in none,
wherever a writer stopped. One writer at a time: a new batch discards staged
files of writers that did not reach their commit.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

STAGING, COMMITS = "_staging", "_commits"


class _Files:
    """The few file-system calls needed, through the session's Hadoop client."""

    def __init__(self, spark: SparkSession, root: str):
        sc = spark.sparkContext
        self.jvm, self.conf = sc._jvm, sc._jsc.hadoopConfiguration()
        self.fs = self.path(root).getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def files(self, name: str) -> list[str]:
        out, found = [], self.fs.listFiles(self.path(name), True) if self.exists(name) else None
        while found is not None and found.hasNext():
            out.append(found.next().getPath().toString())
        return sorted(out)

    def move(self, source: str, target: str) -> None:
        self.fs.mkdirs(self.path(target).getParent())
        if not self.fs.rename(self.path(source), self.path(target)):
            raise OSError(f"cannot move {source} to {target}")

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def write(self, name: str, text: str) -> None:
        out = self.fs.create(self.path(name), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()


def staging_path(root: str, batch: str) -> str:
    return f"{root}/{STAGING}/{batch}"


def begin(spark: SparkSession, root: str) -> None:
    """Finish what was committed and discard what was only staged."""
    recover(spark, root)
    _Files(spark, root).delete(f"{root}/{STAGING}")


def publish(spark: SparkSession, root: str, batch: str, replaced: dict[str, list[str]]) -> None:
    """Commit the staged files of ``batch`` and move them into their tables.
    ``replaced``: per table, partition folders whose present files go."""
    files = _Files(spark, root)
    staged = files.path(staging_path(root, batch)).toUri().getPath()
    steps = [f"delete\t{old}" for table, folders in replaced.items() for folder in folders
             for old in files.files(f"{root}/{table}/{folder}")]
    for f in files.files(staged):
        inside = f[f.index(staged) + len(staged) + 1:]
        if not inside.rsplit("/", 1)[-1].startswith(("_", ".")):
            steps.append(f"move\t{f}\t{root}/{inside}")
    if not steps:
        files.delete(staged)
        return
    name = f"{root}/{COMMITS}/{batch}"
    files.write(f"{name}.tmp", "\n".join(steps))
    files.move(f"{name}.tmp", f"{name}.list")
    _carry_out(files, root, f"{name}.list")


def _carry_out(files: _Files, root: str, commit: str) -> None:
    """The steps of a commit; each may have been done before."""
    for step in files.read(commit).split("\n"):
        kind, *names = step.split("\t")
        if kind == "delete":
            files.delete(names[0])
        elif files.exists(names[0]):
            files.move(*names)
        elif not files.exists(names[1]):
            raise OSError(f"{commit}: {names[0]} is gone and not published")
    files.delete(staging_path(root, commit.rsplit("/", 1)[-1].removesuffix(".list")))
    files.delete(commit)


def recover(spark: SparkSession, root: str) -> int:
    """Carry out the commits whose writers stopped; returns their number."""
    files = _Files(spark, root)
    commits = [f for f in files.files(f"{root}/{COMMITS}") if f.endswith(".list")]
    for commit in commits:
        _carry_out(files, root, commit)
    return len(commits)
