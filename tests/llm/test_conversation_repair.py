"""The agenda against exhaustive search, and the query against a plain version of its contract."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from ratingloom.llm import conversation_repair as cr
from ratingloom.llm.queries import QUERIES, damaged, op12_conversation_repair

LAW = re.compile(r"(s?(ua)+)?")
SPACES = " \t\n\x0b\x0c\r"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        if fault == 0:
            continue
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if fault == 3 else 1)
    return out


def faults(rows):
    seen, found = set(), []
    for _, _, role, text in rows:
        words = text.strip(SPACES)
        found.append("blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else "")
        seen.add((role, text))
    return found


def cheapest(rows, found):
    """Least (cost, audit, repaired rows) by the suffix recurrence over plain strings."""
    step = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    names = {"u": "user", "a": "assistant"}

    def inserted(best):
        for _ in range(4):  # from any state at most a few insertions reach any other
            for p, moves in step.items():
                for c, q in moves.items():
                    if c in names and best[q] is not None:
                        cost, audit, done = best[q]
                        option = (cost + 3, "I" + audit, [(names[c], "")] + done)
                        best[p] = option if best[p] is None else min(best[p], option, key=lambda o: o[:2])
        return best

    best = inserted({"": (0, "", []), "s": None, "u": None, "a": (0, "", [])})
    for (_, _, role, text), fault in reversed(list(zip(rows, found))):
        new = {}
        for p, moves in step.items():
            options = []
            if best[p] is not None:
                cost, audit, done = best[p]
                options.append((cost + 4, "D" + audit, done))
            if fault not in ("blank", "duplicate"):
                left = 3 if fault == "truncated" else 0
                for c, q in moves.items():
                    if best[q] is not None:
                        cost, audit, done = best[q]
                        if c == role[:1]:
                            options.append((cost + left, "K" + audit, [(role, text)] + done))
                        if c in names:
                            options.append((cost + 3 + left, "R" + audit, [(names[c], text)] + done))
            new[p] = min(options, key=lambda o: o[:2]) if options else None
        best = inserted(new)
    return best[""]


def plain(rows):
    """The query's rows by its contract."""
    groups = {}
    for conv, turn, role, text in damage(rows):
        groups.setdefault(conv, []).append((conv, turn, role, text))
    out = []
    for conv in {r[0] for r in rows}:
        mine = sorted(groups.get(conv, []), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        found = faults(mine)
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[2][:1] for r in mine]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, done = cheapest(mine, found)
        digest = hashlib.sha256("\n".join(f"{role}:{text}" for role, text in done).encode()).hexdigest()
        out.append((conv, gaps, found.count("blank"), found.count("duplicate"), found.count("truncated"), illegal, cost, audit, digest))
    return sorted(out, key=repr)


def signature(cells):
    return "".join(cr.code(cr.INITIALS.index(i), f) for i, f in cells)


def exhaustive(cells):
    """Least (cost, audit) over every edit sequence with at most two insertions in a row."""
    best = None
    gaps = ["", "u", "a", "ua", "au"]
    edits = []
    for initial, fault in cells:
        left = 3 if fault == cr.TRUNCATED else 0
        options = [(4, "D", "")]
        if fault in (cr.SOUND, cr.TRUNCATED):
            options += [(left, "K", initial), (3 + left, "R", "u"), (3 + left, "R", "a")]
        edits.append(options)
    for chosen in itertools.product(*edits):
        for inserts in itertools.product(gaps, repeat=len(cells) + 1):
            initials = "".join(inserts[i] + chosen[i][2] for i in range(len(cells))) + inserts[-1]
            if LAW.fullmatch(initials):
                cost = sum(c[0] for c in chosen) + 3 * sum(map(len, inserts))
                audit = "".join("I" * len(inserts[i]) + chosen[i][1] for i in range(len(cells))) + "I" * len(inserts[-1])
                best = min(best, (cost, audit)) if best else (cost, audit)
    return best


def test_agenda_finds_the_least_of_all_edit_sequences():
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 3, 3, 4, 4):
        for _ in range(6):
            cells = [(rng.choice("suua?a"), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(n)]
            cost, plan = cr.repaired(signature(cells))
            assert (cost, plan.translate(cr.TO_AUDIT)) == exhaustive(cells)


def test_blocks_fold_to_the_whole():
    rng = random.Random(2)
    for _ in range(150):
        cells = [(rng.choice("suuaa?"), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(rng.randrange(1, 25))]
        whole = cr.repaired(signature(cells))
        cuts = sorted(rng.sample(range(1, len(cells)), min(len(cells) - 1, rng.randrange(4))))
        pieces = [cells[a:b] for a, b in zip([0, *cuts], [*cuts, len(cells)])]
        cost, plans = cr.folded([cr.block_table(signature(p)) for p in pieces])
        assert (cost, "".join(plans).translate(cr.TO_AUDIT)) == (whole[0], whole[1].translate(cr.TO_AUDIT))


def test_query_on_the_given_table(spark, small_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{small_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op12_conversation_repair"](spark, small_dir)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint"] * 7 + ["string"] * 2
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows)


ODD = [
    (1, 0, "user", "Hello there."), (1, 1, "assistant", "Hello."), (1, 1, "assistant", "Hello."), (1, 5, "user", "Hello there."),
    (2, None, None, None), (2, None, "system", "Be kind."), (2, 3, "user", "no stop"), (2, -4, "", "Empty role."),
    (None, 0, "user", "No number."), (None, None, "assistant", "Yes!"), (None, 1, "assistant", "Yes!"),
    (3, 0, "System", "Upper case."), (3, 1, "usher", "Other u."), (3, 2, "assistant", "ok?\n\t \x0b"), (3, 2, "assistant", "\x0c\r"),
    (4, 0, "assistant", "Long. " * 50_000), (4, 1, "assistant", " "), (5, 7, "user", "Ünïcödé\U0001f600"), (5, 7, "user", "a?"),
    (6, 10**15, "user", "Far."), (6, -(10**15), "assistant", "Away."),
]


def query_on(spark, tmp_path, rows, parts=3, **extra):
    folder = tmp_path / f"t{len(list(tmp_path.iterdir()))}"
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(parts)
    table.withColumns({name: F.lit(value) for name, value in extra.items()}).write.parquet(str(folder / "conversations.parquet"))
    return sorted(map(tuple, op12_conversation_repair(spark, str(folder)).collect()), key=repr)


def test_odd_rows_and_clashing_columns(spark, tmp_path):
    # Many numbers for the same rows, so that each meets every kind of damage.
    rows = [(None if c is None else c + 10 * k, t, r, x) for k in range(30) for c, t, r, x in ODD]
    assert query_on(spark, tmp_path, rows, conv=1, part=2, fault=3, seq="x", digest=4, low=5, plan=6) == plain(rows)


def test_no_rows_and_no_rows_after_damage(spark, tmp_path):
    assert query_on(spark, tmp_path, []) == []
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert query_on(spark, tmp_path, [(gone, 0, "user", "Hi.")]) == [(gone, 0, 0, 0, 0, 0, 0, "", empty)]


@pytest.mark.parametrize("parts", ["1", "7"])
def test_one_conversation_holds_most_rows(spark, tmp_path, parts):
    rng = random.Random(3)
    texts = ["Same again.", "no stop", "Yes!"]
    rows = [(9, t, rng.choice(["user", "assistant", "system"]), rng.choice([*texts, f"Text {t}.", f"Text {t}.", f"Open {t}"])) for t in range(3000)]
    rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"Row {c} {t}.") for c in range(60) for t in range(4) if c != 9]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert query_on(spark, tmp_path, rows) == plain(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)


def test_repaired_rows_keep_the_law(spark, small_dir):
    table = spark.read.parquet(f"{small_dir}/conversations.parquet")
    _, rows = cr.repair(damaged(table))
    groups = {}
    for r in sorted(rows.collect(), key=lambda r: (r["part"], r["block"], r["seq"], r["step"])):
        groups.setdefault(r["conv"], []).append(r["role"][0])
    assert groups and all(LAW.fullmatch("".join(g)) for g in groups.values())


def test_sql_twin_on_odd_rows(spark, tmp_path):
    import duckdb

    from ratingloom.llm.queries import ORACLES

    rows = [(None if c is None else c + 10 * k, t, r, x) for k in range(30) for c, t, r, x in ODD if c != 4]
    path = str(tmp_path / "conversations.parquet")
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(path)
    db = duckdb.connect()
    db.sql(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{path}/*.parquet')")
    assert sorted(db.sql(ORACLES["op12_conversation_repair"]).fetchall(), key=repr) == plain(rows)
