"""Sequential replay in plain Python: the meaning the Spark operators must match."""

import json


def envelope(op, table, before=None, after=None, snapshot=None):
    source = {"table": table}
    if snapshot is not None:
        source["snapshot"] = snapshot
    return json.dumps({"payload": {"op": op, "source": source, "before": before, "after": after}})


def replay_keyed(base, events, keys):
    """`base` and the result: dict key -> row dict. `events`: (op, before, after) in order."""
    table = {k: dict(v) for k, v in base.items()}
    for op, before, after in events:
        if op in "rcu" and after is not None:
            key = tuple(after[k] for k in keys)
            table.setdefault(key, {}).update(after)
        elif op == "d" and before is not None:
            table.pop(tuple(before[k] for k in keys), None)
    return table


def replay_bag(base, events, columns):
    """`base` and the result: list of row tuples. Null before columns match anything; an update sets what its image carries."""
    bag = list(base)
    missed = []
    for position, (op, before, after) in enumerate(events):
        where = {i: before[c] for i, c in enumerate(columns) if before and before.get(c) is not None}
        hits = [all(row[i] == v for i, v in where.items()) for row in bag] if where else None
        row = tuple(after.get(c) for c in columns) if after is not None else None
        if op in "rc" or (op == "u" and not where):
            bag.append(row)
        elif op == "u":
            if not set(after) & set(columns):
                continue
            if any(hits):
                bag = [tuple(after.get(c, x) for c, x in zip(columns, old)) if hit else old for old, hit in zip(bag, hits)]
            else:
                bag.append(row)
                missed.append((position, "update_inserted"))
        elif op == "d" and where:
            if not any(hits):
                missed.append((position, "no_row"))
            bag = [old for old, hit in zip(bag, hits) if not hit]
    return bag, missed
