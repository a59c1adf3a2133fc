"""The stored index: a snapshot of documents, one of texts, and the control row with the high-water mark.

A batch rewrites the slices that hold its documents and moves the mark last. If it fails in between, the page is read
again, and applying a page twice gives the same index. Text is a snapshot of its own, so a metadata change neither reads
nor rewrites it.
"""

from tidemark.schemas import DOCUMENT_COLUMNS, TEXT_COLUMNS
from tidemark.sinks.control import Control
from tidemark.sinks.snapshot import Snapshot

FAMILIES = {"meta": DOCUMENT_COLUMNS, "text": TEXT_COLUMNS}


class IndexStore(Control):
    """slices: how many parts of each snapshot are rewritten apart; buckets: tasks of a join with it. Both are fixed
    when the store is created; a slice should hold some hundred MB."""

    def __init__(self, spark, root, slices=64, buckets=16):
        super().__init__(spark, root)
        self.slices, self.buckets = (self._head["slices"], self._head["buckets"]) if self._head else (slices, buckets)
        self._families = {
            family: Snapshot(spark, f"{self.root}/{family}", columns, self.slices, self.buckets) for family, columns in FAMILIES.items()}
        if self.exists():
            self._open()

    def _open(self):
        for snapshot in self._families.values():
            snapshot.ensure()

    def exists(self):
        """Whether the index (not the control row) has been created."""
        return all(snapshot.exists() for snapshot in self._families.values())

    def ensure(self, create_index=True, create_control=True):
        """Create the control row, then the empty index, each only if asked for and absent."""
        if create_control and self.head() is None:
            self.commit(0, layout=(self.slices, self.buckets))
        if create_index:
            self._open()
        return self

    def commit(self, last_txn_id, progress=None, gaps=None, pending=None, layout=None):
        super().commit(last_txn_id, progress, gaps, pending, layout or (self.slices, self.buckets))

    def read(self, family, slices=None):
        return self._families[family].read(slices)

    def write(self, family, rows, slices):
        self._families[family].write(rows, slices)

    def index(self):
        """The whole index: metadata with the text beside it where there is any, joined bucket by bucket."""
        return self.read("meta").join(self.read("text"), "uuid", "left")
