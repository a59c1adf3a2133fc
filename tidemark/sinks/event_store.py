"""An index of events that carry their own fields: a last-writer-wins map for each key.

Each stored field keeps the place in the feed it was written at, and a delete is kept as a place too. The state of a key
is the greatest of each, whatever order events come in and however often, so late and repeated events are applied like
any other.
"""

from pyspark.sql import functions as F

from tidemark.operators.net_state import alive_documents, field_states, merge_states, state_columns
from tidemark.sinks.control import Control
from tidemark.sinks.snapshot import Snapshot, slice_of, staged


class EventStore(Control):
    """order: the columns, by name and type, whose tuple is an event's place in the feed."""

    def __init__(self, spark, root, order, slices=64, buckets=16):
        super().__init__(spark, root)
        self.order = dict(order)
        self.slices, self.buckets = (self._head["slices"], self._head["buckets"]) if self._head else (slices, buckets)
        self._states = Snapshot(spark, f"{self.root}/states", state_columns(self.order), self.slices, self.buckets).ensure()
        if self._head is None:
            self.commit(0, layout=(self.slices, self.buckets))

    def apply(self, events, mark, progress=None):
        """Merge events (uuid, is_delete, fields and the order columns) and move the mark."""
        incoming = staged(field_states(events, "uuid", list(self.order)).withColumn("slice", slice_of("uuid", self.slices)), f"{self.root}/work/states")
        slices = [r[0] for r in incoming.select("slice").distinct().collect()]
        if slices:
            self._states.write(merge_states(self._states.read(slices), incoming), slices)
        self.commit(mark, progress)

    def states(self):
        return self._states.read()

    def documents(self):
        """uuid and fields of the keys that are not deleted."""
        return alive_documents(self.states())
