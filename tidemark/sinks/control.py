"""The control row of a store: its high-water mark, the progress of its streams and its layout."""

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemark.schemas import COMMIT
from tidemark.sinks.snapshot import files


class CommitConflict(RuntimeError):
    """Another writer has made this commit."""


class Control:
    """Commits, each a row in a folder of its own that is created once and never written again.

    A writer goes on from the commit it has read. If another one has committed since, its own commit fails, and what it
    applied is applied again from the new mark. The last KEPT commits are kept.
    """

    KEPT = 100

    def __init__(self, spark, root):
        self.spark, self.root, self._head = spark, root.rstrip("/"), None
        self.refresh()

    def _path(self, commit_id):
        return f"{self.root}/commits/c={commit_id}"

    def _rows(self, commit_id):
        try:
            return self.spark.read.schema(COMMIT).parquet(self._path(commit_id)).collect()
        except AnalysisException as error:
            if "PATH_NOT_FOUND" in str(error):
                return []
            raise

    def _ids(self):
        system, path = files(self.spark, f"{self.root}/commits")
        names = [s.getPath().getName() for s in system.listStatus(path)] if system.exists(path) else []
        return sorted(int(n[2:]) for n in names if n.startswith("c="))

    def refresh(self):
        """The last whole commit, or None."""
        for commit_id in reversed(self._ids()):
            if self._head is not None and commit_id <= self._head["commit_id"]:
                break
            rows = self._rows(commit_id)
            if rows:
                self._head = rows[0]
                break
        return self._head

    def head(self):
        return self._head

    def watermark(self):
        """Last indexed transaction id, 0 before the first commit."""
        return self._head["last_txn_id"] if self._head else 0

    def has_applied(self, stream, batch):
        """Whether this micro-batch of a stream, or a later one, is committed."""
        head = self.refresh()
        return bool(head) and head["streams"].get(stream, -1) >= batch

    def next_commit(self):
        return self._head["commit_id"] + 1 if self._head else 0

    def open_gaps(self):
        """from_id, to_id: ranges below the mark whose transactions had not come at the last commit; None without any record."""
        where = self._head and self._head["gaps"]
        return None if where is None else self.spark.read.schema("from_id bigint, to_id bigint").parquet(f"{self.root}/gaps/c={where}")

    def pending(self):
        """id, rule, tries: nodes that could not be indexed and wait to be driven again; None without any record."""
        where = self._head and self._head["pending"]
        return None if where is None else self.spark.read.schema("id bigint, rule string, tries bigint").parquet(f"{self.root}/pending/c={where}")

    def commit(self, last_txn_id, progress=None, gaps=None, pending=None, layout=None):
        """Publish the mark, which never moves back, with the progress of a stream (its name and micro-batch), the gaps
        left open below the mark and the nodes that are pending."""
        commit_id, head, writer = self.next_commit(), self._head, uuid.uuid4().hex
        taken = CommitConflict(f"commit {commit_id} of {self.root} is another writer's")
        if self._rows(commit_id):
            raise taken
        for name, rows in (("gaps", gaps), ("pending", pending)):
            if rows is not None:
                rows.write.mode("overwrite").parquet(f"{self.root}/{name}/c={commit_id}")
        streams = {**(head["streams"] if head else {}), **dict([progress] if progress else [])}
        mark = max(last_txn_id, self.watermark())
        tables = [commit_id if rows is not None else head and head[name] for name, rows in (("gaps", gaps), ("pending", pending))]
        slices, buckets = layout or (head["slices"], head["buckets"])
        row = self.spark.createDataFrame([(commit_id, mark, slices, buckets, streams, *tables, writer)], COMMIT)
        # a folder without a row is what an interrupted commit has left
        row.coalesce(1).write.mode("append").parquet(self._path(commit_id))
        rows = self._rows(commit_id)
        if min(r["writer"] for r in rows) != writer:
            raise taken
        self._head = rows[0] if len(rows) == 1 else min(rows, key=lambda r: r["writer"])
        self._forget(commit_id - self.KEPT)

    def _forget(self, last):
        for commit_id in self._ids():
            if commit_id <= last:
                kept = [name for name in ("gaps", "pending") if commit_id != self._head[name]]
                for path in (self._path(commit_id), *(f"{self.root}/{name}/c={commit_id}" for name in kept)):
                    system, path = files(self.spark, path)
                    system.delete(path, True)
