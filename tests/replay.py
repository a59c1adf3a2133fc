"""Sequential model of the index: one change at a time, the way the results are defined."""


class Index(dict):
    """uuid -> {"stamp", "optional": {...}, "always": {...}, "fields": {...}}"""

    def upsert(self, uuid, stamp, always, optional, fields, mode="partial"):
        old = self.get(uuid)
        if old is None:
            self[uuid] = {"stamp": stamp, "always": dict(always), "optional": dict(optional), "fields": dict(fields)}
            return
        if old["stamp"] is not None and stamp is not None and old["stamp"] > stamp:
            return
        if mode == "replace":
            self[uuid] = {"stamp": stamp, "always": dict(always), "optional": dict(optional), "fields": dict(fields)}
            return
        old["stamp"] = stamp
        old["always"].update(always)
        old["optional"].update(optional)
        old["fields"].update(fields)

    def delete(self, uuid):
        self.pop(uuid, None)


def replay_fields(events):
    """events: (uuid, is_delete, fields) in feed order -> (op, reset, fields) per uuid."""
    state, reset, op = {}, {}, {}
    for uuid, is_delete, fields in events:
        reset.setdefault(uuid, False)
        if is_delete:
            state[uuid], reset[uuid], op[uuid] = {}, True, "delete"
        else:
            state.setdefault(uuid, {}).update(fields or {})
            op[uuid] = "upsert"
    return {u: (op[u], reset[u], state[u]) for u in op}
