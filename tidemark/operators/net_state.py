"""Order-dependent replay of a change feed, expressed as aggregations."""

from pyspark.sql import functions as F

from tidemark.operators.lookups import hot_keys


def state_columns(order):
    """Columns and types of a key's state, from those of the order."""
    place = f"struct<{','.join(f'`{name}`:{kind}' for name, kind in order.items())}>"
    return {"last_delete": place, "last_update": place, "writes": f"map<string,struct<seq:{place},value:string>>"}


def field_states(events, key, order, fields="fields"):
    """State of each key: the last delete and update (as tuples of the order columns) and the last write of each field
    that no delete follows.

    `events` carries `is_delete` (see feed.routed) and, for updates, a map of the fields the change names. An update
    replaces whatever an earlier one of the same fields wrote, so events are first folded by key and set of names. They
    are dealt out by key before that: the fold sorts, and what one map task reads is too much to sort at once. A hot key
    is dealt to as many tasks as its share asks for, and arrives as few rows at the second fold. Writes older than the
    last delete go before the sets expand to single fields.
    """
    events = _dealt(events, key, order)
    is_delete = F.col("is_delete")
    named = F.when(~is_delete, F.array_sort(F.map_entries(fields)))
    events = events.select(F.col(key), "_part", is_delete, F.struct(*[F.col(c) for c in order]).alias("seq"), named.alias("_entries"))
    folded = events.select(key, "_part", "is_delete", "seq", F.col("_entries.key").alias("names"), F.col("_entries.value").alias("values"))
    folded = folded.groupBy(key, "_part", "is_delete", "names").agg(F.max(F.struct("seq", "values")).alias("last"))
    written = F.when(~is_delete & (F.size("names") > 0), F.struct("names", "last.seq", "last.values"))
    gathered = folded.groupBy(key).agg(
        F.max(F.when(is_delete, F.col("last.seq"))).alias("last_delete"),
        F.max(F.when(~is_delete, F.col("last.seq"))).alias("last_update"),
        F.collect_list(written).alias("_sets"),
    )
    live = F.filter("_sets", lambda s: F.col("last_delete").isNull() | (s["seq"] > F.col("last_delete")))
    singles = F.flatten(F.transform(live, lambda s: F.zip_with(
        s["names"], s["values"], lambda name, value: F.struct(name.alias("field"), s["seq"].alias("seq"), value.alias("value")))))
    # sorted by field and place, the last of each field is the one to keep
    ordered = gathered.withColumn("_sets", F.array_sort(singles))
    last = F.filter("_sets", lambda w, i: ~w["field"].eqNullSafe(F.get(F.col("_sets"), i + 1)["field"]))
    return ordered.select(
        key, "last_delete", "last_update",
        F.map_from_entries(F.transform(last, lambda w: F.struct(w["field"], F.struct(w["seq"], w["value"])))).alias("writes"))


def _dealt(events, key, order):
    """Events dealt out by _part, a hash of key and salt; the rows of a hot key have several salts. Keys are counted by
    their hash: one that shares it with a hot key is salted too, which does no harm."""
    spark = events.sparkSession
    hashed = events.withColumn("_hash", F.xxhash64(key))
    hot = hot_keys(hashed, "_hash", int(spark.conf.get("spark.sql.shuffle.partitions")))
    salts = F.broadcast(spark.createDataFrame(list(hot.items()), "_hash long, _salts int"))
    salt = F.pmod(F.xxhash64(*order), F.coalesce("_salts", F.lit(1)))
    return hashed.join(salts, "_hash", "left").withColumn("_part", F.hash(key, salt)).drop("_hash", "_salts").repartition("_part")


def merge_states(stored, incoming, key="uuid"):
    """States of both sides by one full outer join: the greater place wins for each field, delete and update, so the
    order in which states are merged doesn't matter."""
    old, new = stored.alias("old"), incoming.alias("new")
    joined = old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer")

    def later(name):
        return F.greatest(F.col(f"old.{name}"), F.col(f"new.{name}"))

    a, b = F.col("old.writes"), F.col("new.writes")
    both = F.when(a.isNull(), b).when(b.isNull(), a).otherwise(F.map_zip_with(a, b, lambda name, x, y: F.greatest(x, y)))
    merged = joined.select(F.coalesce(f"old.{key}", f"new.{key}").alias(key), later("last_delete").alias("last_delete"),
                           later("last_update").alias("last_update"), both.alias("writes"))
    alive = F.map_filter("writes", lambda name, w: F.col("last_delete").isNull() | (w["seq"] > F.col("last_delete")))
    return merged.withColumn("writes", alive)


def alive_documents(states, key="uuid", fields="fields"):
    """Keys that are not deleted, with the values of their fields."""
    return states.where(_op(F.col("last_update"), F.col("last_delete")) == "upsert").select(key, _values().alias(fields))


def _values():
    return F.transform_values("writes", lambda name, w: w["value"])


def net_state(events, key, order, fields="fields"):
    """Net effect of a feed per key: last writer wins per field and a delete forgets what came before. Returns key, op
    ("upsert" / "delete"), reset (a delete occurred in this feed) and the surviving fields. `order` lists the columns
    whose tuple gives the feed order."""
    return field_states(events, key, order, fields).select(
        key, _op(F.col("last_update"), F.col("last_delete")).alias("op"), F.col("last_delete").isNotNull().alias("reset"), _values().alias(fields))


def latest_changes(changes, key, order, carry):
    """Net change per key when metadata is read as of now: one row per key with the `carry` columns of its
    last update, op and reset. Equal to replaying every change, because each replay writes the same document."""
    is_delete, seq = F.col("is_delete"), F.struct(*[F.col(c) for c in order])
    folded = changes.groupBy(key).agg(
        F.max(F.when(is_delete, seq)).alias("last_delete"),
        F.max_by(F.struct(seq.alias("seq"), *carry), F.when(~is_delete, seq)).alias("last_update"),
    )
    return folded.select(
        key,
        _op(F.col("last_update.seq"), F.col("last_delete")).alias("op"),
        F.col("last_delete").isNotNull().alias("reset"),
        *[F.col(f"last_update.{c}").alias(c) for c in carry],
    )


def latest_value(rows, key, order, value):
    """Last value per key tuple in feed order, a null counting as a value."""
    return rows.groupBy(*key).agg(
        F.max_by(F.struct(value), F.struct(*[F.col(c) for c in order])).alias("last")
    ).select(*key, F.col(f"last.{value}").alias(value))


def _op(last_update, last_delete):
    alive = last_update.isNotNull() & (last_delete.isNull() | (last_update > last_delete))
    return F.when(alive, F.lit("upsert")).otherwise(F.lit("delete"))
