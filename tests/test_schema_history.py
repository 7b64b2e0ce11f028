"""Tables and columns through time, against a sequential replay in Python."""

import random

import pytest

from rowtide.operators import lineage, ordered, schema

LOG = "event_type string, db string, tbl string, query string, pos_key long, row_no int"
BASE = [("id", "bigint", "PRI", ""), ("v", "double", "", "")]


class Replay:
    """A database that runs statements one by one."""

    def __init__(self):
        self.tables, self.versions, self.made = {}, [], 0

    def start(self, name):
        self.new(name, [[n, t] for n, t, *_ in BASE], {"PRIMARY": ("PRI", ["id"])}, 0)

    def new(self, name, columns, keys, pos):
        self.tables[name] = {"id": self.made, "cols": columns, "keys": keys, "v": -1}
        self.made += 1
        self.mark(name, pos)

    def mark(self, name, pos):
        t = self.tables[name]
        self.close(t, pos)
        t["v"] += 1
        t["open"] = (name, t["v"], pos, [(n, k, self.key(t, n)) for n, k in t["cols"]])

    def close(self, t, pos):
        if "open" in t:
            name, v, start, cols = t.pop("open")
            self.versions += [("d", name, v, i + 1, n, k, key, start, pos) for i, (n, k, key) in enumerate(cols)]

    @staticmethod
    def key(t, column):
        found = [3 if kind == "PRI" else 2 if kind == "UNI" and len(cols) == 1 else 1
                 for kind, cols in t["keys"].values() if column in cols and (kind == "PRI" or cols[0] == column)]
        return {3: "PRI", 2: "UNI", 1: "MUL", 0: ""}[max(found, default=0)]

    def at(self, t, name):
        return [n for n, _ in t["cols"]].index(name)

    def put(self, t, col, place):
        if place is None:
            t["cols"].append(col)
        elif place == "FIRST":
            t["cols"].insert(0, col)
        else:
            t["cols"].insert(self.at(t, place) + 1, col)

    def drop_column(self, t, name):
        del t["cols"][self.at(t, name)]
        for k in list(t["keys"]):
            kind, cols = t["keys"][k]
            t["keys"][k] = (kind, [c for c in cols if c != name])
            if not t["keys"][k][1]:
                del t["keys"][k]


def history(rng, steps, tables=3):
    """(log rows, rows of every version) of random valid statements."""
    db, rows, fresh = Replay(), [], iter(range(10 ** 6))
    names = [f"t{i}" for i in range(tables)]
    for n in names:
        db.start(n)
        rows.append(("insert", "d", n, "", 1, 0))
    types = ["INT", "VARCHAR(9)", "DECIMAL(8,2)", "ENUM('a','b, c')"]
    for step in range(steps):
        pos, name = (step + 1) * 10, rng.choice(sorted(db.tables) or ["none"])
        t = db.tables.get(name)
        if t is None or rng.random() < 0.05:
            name = f"n{next(fresh)}" if rng.random() < 0.5 else f"t{rng.randrange(tables)}"
            if name in db.tables:
                continue
            db.new(name, [["id", "int"], ["w", "int"]], {"PRIMARY": ("PRI", ["id"])}, pos)
            rows.append(("query", "d", name, f"CREATE TABLE {name} (id INT PRIMARY KEY, w INT)", pos, 0))
            continue
        kind = rng.random()
        if kind < 0.04:
            db.close(t, pos)
            del db.tables[name]
            rows.append(("query", "d", name, f"DROP TABLE `{name}`", pos, 0))
            continue
        if kind < 0.14:
            new = rng.choice([f"t{rng.randrange(tables)}", f"n{next(fresh)}"])
            if new in db.tables:
                other = db.tables[new]  # swap by way of a third name
                sql = f"RENAME TABLE {name} TO tmp, {new} TO {name}, tmp TO {new}"
                db.tables[name], db.tables[new] = other, t
                if name != new:
                    db.mark(name, pos)
                    db.mark(new, pos)
                else:
                    continue
            else:
                sql = rng.choice([f"RENAME TABLE {name} TO {new}", f"ALTER TABLE {name} RENAME TO `{new}`"])
                db.tables[new] = db.tables.pop(name)
                db.mark(new, pos)
            rows.append(("query", "d", name, sql, pos, 0))
            continue
        clauses = []
        for _ in range(rng.randrange(1, 4)):
            have = [n for n, _ in t["cols"]]
            what = rng.choice(["add", "add", "drop", "modify", "change", "rename", "key", "unkey"])
            new, typ = f"c{next(fresh)}" if rng.random() < 0.6 else f"r{rng.randrange(4)}", rng.choice(types)
            place = rng.choice([None, None, "FIRST", *have]) if have else None
            if what != "add" and not have or what != "add" and what not in ("key", "unkey") and not have:
                continue
            old = rng.choice(have) if have else None
            if what in ("modify", "change") and place == old:
                place = None
            after = "" if place is None else " FIRST" if place == "FIRST" else f" AFTER `{place}`"
            if what == "add" and new not in have:
                db.put(t, [new, typ.lower()], place)
                clauses.append(f"ADD COLUMN `{new}` {typ} COMMENT 'x, FIRST'{after}")
            elif what == "drop" and len(have) > 1:
                db.drop_column(t, old)
                clauses.append(f"DROP {old}")
            elif what in ("modify", "change"):
                target = new if what == "change" and new not in have else old
                i = db.at(t, old)
                if place is None:
                    t["cols"][i] = [target, typ.lower()]
                else:
                    del t["cols"][i]
                    db.put(t, [target, typ.lower()], place)
                t["keys"] = {k: (kd, [target if c == old else c for c in cs]) for k, (kd, cs) in t["keys"].items()}
                clauses.append((f"MODIFY {old}" if target == old and what == "modify" else f"CHANGE {old} {target}") + f" {typ} NOT NULL{after}")
            elif what == "rename" and new not in have:
                t["cols"][db.at(t, old)][0] = new
                t["keys"] = {k: (kd, [new if c == old else c for c in cs]) for k, (kd, cs) in t["keys"].items()}
                clauses.append(f"RENAME COLUMN {old} TO {new}")
            elif what == "key":
                cols = rng.sample(have, min(len(have), rng.randrange(1, 3)))
                k, kd = rng.choice([(f"k{next(fresh)}", "UNI"), (f"k{next(fresh)}", "MUL"), ("PRIMARY", "PRI")])
                if k not in t["keys"]:
                    t["keys"][k] = (kd, cols)
                    listed = ", ".join(f"`{c}`(5)" if kd == "MUL" else c for c in cols)
                    clauses.append({"UNI": f"ADD UNIQUE KEY {k} ({listed})", "MUL": f"ADD INDEX `{k}` ({listed})", "PRI": f"ADD PRIMARY KEY ({listed})"}[kd])
            elif what == "unkey" and t["keys"]:
                k = rng.choice(sorted(t["keys"]))
                del t["keys"][k]
                clauses.append("DROP PRIMARY KEY" if k == "PRIMARY" else f"DROP INDEX {k}")
        if clauses:
            db.mark(name, pos)
            rows.append(("query", "d", name, f"ALTER TABLE {name} " + ", ".join(clauses), pos, 0))
    for t in db.tables.values():
        db.close(t, None)
    return rows, sorted(db.versions, key=str)


def versions(spark, rows):
    got = schema.schema_columns(spark.createDataFrame(rows, LOG), BASE).drop("table")
    return sorted(map(tuple, got.collect()), key=str)


@pytest.mark.parametrize("seed, hot", [(1, None), (2, 0)])
def test_columns_equal_a_replay(spark, seed, hot, monkeypatch):
    if hot is not None:
        monkeypatch.setattr(ordered, "HOT_ROWS", hot)
    rows, want = history(random.Random(seed), 110)
    assert versions(spark, rows) == want and len(want) > 200


def test_moved_columns_leave_their_place(spark):
    rows = [("query", "d", "t", q, 10 * (i + 1), 0) for i, q in enumerate([
        "ALTER TABLE t ADD a INT AFTER id, ADD b INT AFTER a", "ALTER TABLE t MODIFY a INT FIRST", "ALTER TABLE t ADD c INT AFTER a, DROP b",
        "ALTER TABLE t ADD b TEXT AFTER id", "ALTER TABLE t CHANGE id ID BIGINT, RENAME COLUMN a TO `x y`", "ALTER TABLE t ADD COLUMN IF NOT EXISTS B INT FIRST",
        "ALTER TABLE t DROP nothing, MODIFY gone INT FIRST"])]
    orders = {}
    for r in sorted(versions(spark, rows), key=lambda r: (r[2], r[3])):
        orders.setdefault(r[2], []).append(r[4])
    assert orders == {0: ["id", "v"], 1: ["id", "a", "b", "v"], 2: ["a", "id", "b", "v"], 3: ["a", "c", "id", "v"], 4: ["a", "c", "id", "b", "v"],
                      5: ["x y", "c", "ID", "b", "v"], 6: ["x y", "c", "ID", "b", "v"], 7: ["x y", "c", "ID", "b", "v"]}


def test_keys_of_versions(spark):
    rows = [("query", "d", "t", q, 10 * (i + 1), 0) for i, q in enumerate([
        "ALTER TABLE t DROP PRIMARY KEY, ADD PRIMARY KEY (v, id)", "ALTER TABLE t RENAME COLUMN v TO w", "ALTER TABLE t DROP id", "ALTER TABLE t DROP PRIMARY KEY",
        "ALTER TABLE t ADD k INT PRIMARY KEY FIRST"])]
    got = schema.keys_of_versions(schema.schema_columns(spark.createDataFrame(rows, LOG), BASE)).orderBy("version").collect()
    assert [(r.version, r.primary_keys, r.primary, r.n_keys, r.n_columns) for r in got] == [
        (0, "id", "id", 1, 2), (1, "id,v", "v", 2, 2), (2, "id,w", "w", 2, 2), (3, "w", "w", 1, 1), (4, "", None, 0, 1), (5, "k", "k", 1, 2)]


def test_identity_through_renames(spark):
    def q(sql, pos, tbl="t"):
        return ("query", "d", tbl, sql, pos, 0)

    def change(tbl, pos):
        return ("update", "d", tbl, "", pos, 0)

    rows = [change("a", 5), q("RENAME TABLE a TO tmp, b TO a, tmp TO b", 10), change("a", 11), change("b", 12), q("ALTER TABLE b RENAME TO e.c", 20, "b"),
            ("update", "e", "c", "", 21, 0), change("b", 22), q("CREATE TABLE b (x INT)", 30, "b"), change("b", 31), q("DROP TABLE IF EXISTS b, never", 40, "b"),
            change("b", 41), q("CREATE TABLE b (y INT)", 50, "b"), change("b", 51)]
    log = spark.createDataFrame(rows, LOG)
    got = schema.table_identity(log, schema.table_lives(log, schema.ddl_statements(log)))
    who = {(r.tbl, r.pos_key): (r.born, r.first_tbl, r.last_db, r.last_tbl, r.n_names) for r in got.where("event_type = 'update'").collect()}
    one, two = (0, "a", "e", "c", 4), (0, "b", "d", "a", 2)
    none = (None,) * 5
    assert who == {("a", 5): one, ("a", 11): two, ("b", 12): one, ("c", 21): one, ("b", 22): none, ("b", 31): (30, "b", "d", "b", 1), ("b", 41): none,
                   ("b", 51): (50, "b", "d", "b", 1)}
    # a rename's and a DROP's own event belong to the old table, a CREATE's to the new one
    own = {r.pos_key: r.born for r in got.where("event_type = 'query'").select("pos_key", "born").collect()}
    assert own[20] == 0 and own[30] == 30 and own[40] == 30 and own[50] == 50


def test_chains_of_any_length(spark):
    n = 70
    links = spark.createDataFrame([(f"{i}", f"{i - 1}" if i else None, [i]) for i in range(n)] + [("x", "absent", [0])], "id string, parent string, value array<int>")
    got = {r.id: (r.root, r.value) for r in lineage.follow(links, lambda own, above: schema.F.concat(above, own)).collect()}
    assert got == {f"{i}": ("0", list(range(i + 1))) for i in range(n)} | {"x": ("x", [0])}


def test_nothing_to_read(spark):
    log = spark.createDataFrame([("insert", "d", "t", "", 3, 0)], LOG)
    assert versions(spark, [("insert", "d", "t", "", 3, 0)]) == sorted([("d", "t", 0, 1, "id", "bigint", "PRI", 0, None), ("d", "t", 0, 2, "v", "double", "", 0, None)], key=str)
    assert schema.schema_columns(log.limit(0), BASE).count() == 0
