"""State machines over ordered rows: any rules, keys of any size.

What a signal does is a map from state to state, and maps compose: what a stretch of rows does is one map too, an array
with a small number per state. So a key is cut into chunks of consecutive rows, each is folded into its map, the maps
are composed along the chunks of a slice and along the slices of a key, and with the state that each chunk starts from
known, its rows are gone through once more. No step holds more than one chunk of rows, or one map per chunk of a slice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapwise.operators.ordered import OrderedRows
from lapwise.operators.slices import same_keys

#: Rows that are folded as one array.
CHUNK_ROWS = 1_024

Rules = Mapping[str, Mapping[str, str]]


def signal_maps(
    set_rules: Mapping[str, str], conditional_rules: Mapping[str, tuple[str, str] | Mapping[str, str]], initial: str
) -> tuple[list[str], dict[str, list[int]]]:
    """All states, the initial one first, and per signal the number of the state that each of them turns into."""
    moves = {s: dict([rule]) if isinstance(rule, tuple) else dict(rule) for s, rule in conditional_rules.items()}
    named = [*set_rules.values(), *(state for rule in moves.values() for pair in rule.items() for state in pair)]
    states = list(dict.fromkeys([initial, *named]))
    number = {state: i for i, state in enumerate(states)}
    maps = {}
    for signal in dict.fromkeys([*set_rules, *moves]):
        # A condition that is met goes before the state that the signal otherwise sets.
        maps[signal] = [number[moves.get(signal, {}).get(state, set_rules.get(signal, state))] for state in states]
    return states, maps


def _numbers(values: Sequence[int]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<int>")


def _then(first: Column, second: Column) -> Column:
    """The map that does ``first`` and then ``second``."""
    return F.transform(first, lambda state: F.get(second, state))


def _entered(steps: Column, start: Column) -> Column:
    """The state before each of the steps (structs with a ``map``), from the state before the first."""
    grow = lambda found, step: F.concat(found, F.array(F.get(step["map"], F.element_at(found, -1))))
    return F.slice(F.aggregate(steps, F.array(start), grow), 1, F.size(steps))


def fold_states(
    rows: OrderedRows, signal: str, set_rules: Mapping[str, str], conditional_rules: Mapping, initial: str, state: str
) -> OrderedRows:
    """Rows whose signal changes the state, with the state it changes to.

    ``rows`` are those with a signal that has a rule; their order has to be unique within a key.
    """
    states, maps = signal_maps(set_rules, conditional_rules, initial)
    identity = _numbers(range(len(states)))
    names = F.array(*[F.lit(s) for s in states])
    effects = F.array(*[_numbers(m) for m in maps.values()])
    effect = F.lit(0)
    for i, name in enumerate(maps):
        effect = F.when(F.col(signal) == name, i).otherwise(effect)

    keys, slices = list(rows.keys), rows.slices.columns
    place = [*keys, *slices]
    columns = [c for c in rows.df.columns if c not in place]
    numbered = rows.df.withColumn("_n", F.row_number().over(rows.window()))
    each = F.struct("_n", effect.alias("effect"), F.struct(*columns).alias("row"))
    by_number = lambda a, b: a["_n"] - b["_n"]
    # Chunks lie within the partitions of the window, so this needs no further shuffle.
    chunk = F.floor((F.col("_n") - 1) / CHUNK_ROWS).cast("int").alias("_chunk")
    chunks = numbered.groupBy(*place, chunk).agg(F.array_sort(F.collect_list(each), by_number).alias("_rows"))

    whole = F.aggregate("_rows", identity, lambda done, r: _then(done, F.get(effects, r["effect"])))
    folded = chunks.select(*place, "_chunk", whole.alias("map"))
    steps = F.array_sort(F.collect_list(F.struct("_chunk", "map"))).alias("_steps")
    per_slice = folded.groupBy(*place).agg(steps)
    if slices:
        total = F.aggregate("_steps", identity, lambda done, step: _then(done, step["map"]))
        ordered = F.array_sort(F.collect_list(F.struct(*slices, total.alias("map")))).alias("_slices")
        per_key = per_slice.groupBy(*keys).agg(ordered).withColumn("_starts", _entered(F.col("_slices"), F.lit(0)))
        starts = per_key.select(*keys, F.explode(F.arrays_zip("_slices", "_starts")).alias("_each")).select(
            *[F.col(k).alias(f"_of{k}") for k in keys],
            *[F.col(f"_each._slices.{c}").alias(f"_of{c}") for c in slices],
            F.col("_each._starts").alias("_start"),
        )
        per_slice = per_slice.join(starts, same_keys([(c, f"_of{c}") for c in place])).drop(*[f"_of{c}" for c in place])
    else:
        per_slice = per_slice.withColumn("_start", F.lit(0))
    entered = per_slice.withColumn("_states", _entered(F.col("_steps"), F.col("_start")))
    entered = entered.select(*place, F.explode(F.arrays_zip("_steps", "_states")).alias("_each")).select(
        *[F.col(c).alias(f"_of{c}") for c in place],
        F.col("_each._steps._chunk").alias("_of_chunk"),
        F.col("_each._states").alias("_state"),
    )

    def step(found: Column, r: Column) -> Column:
        now = F.get(F.get(effects, r["effect"]), found["state"])
        changes = F.array(F.struct(now.alias("state"), r["row"].alias("row")))
        return F.struct(now.alias("state"), F.when(now != found["state"], F.concat(found["changes"], changes)).otherwise(found["changes"]).alias("changes"))

    kind = chunks.select(F.array(F.struct(F.lit(0).alias("state"), F.get("_rows", F.lit(0))["row"].alias("row")))).schema[0].dataType.simpleString()
    nothing = F.struct(F.col("_state").alias("state"), F.array().cast(kind).alias("changes"))
    joined = chunks.join(entered, same_keys([(c, f"_of{c}") for c in [*place, "_chunk"]]))
    gone_through = F.aggregate("_rows", nothing, step)["changes"]
    changed = joined.select(*place, F.explode(gone_through).alias("_change")).select(
        *place, *[F.col(f"_change.row.{c}").alias(c) for c in columns], F.get(names, F.col("_change.state")).alias(state)
    )
    return rows.with_df(changed.select(*rows.df.columns, state))
