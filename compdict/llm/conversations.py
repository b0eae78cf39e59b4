"""Conversation structure repair: the cheapest edit script to a well-formed role sequence.

Rows of a conversation are taken in order (turn, nulls first; then role and text).  Each row has
at most one fault, the first of: *blank* (no character outside ``[\\x20\\x09-\\x0D]``),
*duplicate* (same role and text as an earlier row) or *truncated* (its last such character is
not ``.``, ``!`` or ``?``).  Edits: Keep 0, Rerole to user or assistant 1, Delete 2 (the only edit
of a blank or duplicate row), Insert an empty user or assistant row 5; a truncated row that is
not deleted adds 5.  The repaired role initials must read ``(s?(ua)+)?``.  ``audit`` is the edit
initials of the cheapest script; among equally cheap scripts the ASCII-least.

Method.  Nodes are (row position, automaton state) with states start, after-s, after-u,
after-a.  Each edit letter leads from a node to exactly one node (the automaton is deterministic
per letter), so the least script follows, from each node, the smallest letter on an arc of an
optimal path.  The work is cut into blocks of ``BLOCK`` consecutive rows of a conversation:

1. a block's min-plus transfer matrix (4 x 4: cost from each state at its first row to each
   state after its last) is folded with SQL higher-order functions;
2. suffix products of the matrices are doubled, ``2^k`` blocks a round, so every block learns
   the cost-to-go after it in ``log2(blocks)`` joins;
3. in each block (Python, one block a group) the cost-to-go is run back over its rows and the
   least optimal path is followed from each of the four entry states, giving the block's state
   map;
4. prefix compositions of the state maps are doubled the same way, giving each block its true
   entry state (doubled pointers along the least path);
5. each block writes its piece of the audit and of the repaired text; the pieces of a
   conversation are joined in block order.

Steps 3 and 5 run in Python over buckets of whole blocks (about ``BUCKET_BYTES`` of text a
bucket); step 3 is needed only by conversations of more than one block, whose entry states are
not known without it.

No conversation is ever held by one task before the last step, which must form its one audit
string and one hash.

Odd rows: null role or text is one space; a null turn sorts first; a null conversation ID is a
conversation of its own; an empty table gives no rows; repeated rows are rows (the second is a
duplicate); input columns other than the four are not read.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from compdict.checkpoints import cut
from compdict.llm.common import ship
from compdict.operators.ids import number_within

# --- fixed values: edit costs and the grammar (s?(ua)+)? as an automaton over role initials
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
NEXT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
ACCEPT = (0, 3)
FILL = {0: "u", 1: "u", 2: "a", 3: "u"}  # the one user/assistant initial each state takes
ROLE = {"u": "user", "a": "assistant"}
ENDS = ".!?"
SPACE = r"[\x20\x09-\x0D]"
BLOCK = 4096
BUCKET_BYTES = 32 << 20
# block tables up to this many rows are broadcast to the rows; larger ones are joined by a shuffle
BROADCAST_BLOCKS = 1_000_000
INF = 1 << 40
# row kinds: blank, duplicate (both must go), truncated, ordinary
BLANK, DUPLICATE, TRUNC, PLAIN = "B", "P", "T", "O"


# ---- the automaton in Python ------------------------------------------------------------

def _insert_to(g: int) -> int:
    return NEXT[g][FILL[g]]


def close(v: list[int]) -> list[int]:
    """Cost-to-go at one position once inserts there are allowed."""
    v = list(v)
    for _ in range(4):
        for g in range(4):
            v[g] = min(v[g], INSERT + v[_insert_to(g)], INF)
    return v


def arcs(g: int, kind: str, initial: str) -> list[tuple[str, int, int]]:
    """``(letter, cost, next state)`` of the edits that take one row from state ``g``."""
    out = [("D", DELETE, g)]
    if kind in (BLANK, DUPLICATE):
        return out
    extra = TRUNCATED if kind == TRUNC else 0
    if initial in NEXT[g]:
        out.append(("K", KEEP + extra, NEXT[g][initial]))
    if FILL[g] != initial:
        out.append(("R", REROLE + extra, NEXT[g][FILL[g]]))
    return out


END = close([0 if g in ACCEPT else INF for g in range(4)])


def _row_matrix(kind: str, initial: str) -> list[int]:
    """Min-plus matrix of one row: inserts before it, then one of its edits."""
    closure = []
    for g in range(4):
        # cost from g to h by inserts only
        reach = [INF] * 4
        reach[g] = 0
        for _ in range(4):
            for h in range(4):
                if reach[h] < INF:
                    t = _insert_to(h)
                    reach[t] = min(reach[t], reach[h] + INSERT)
        closure.append(reach)
    out = [INF] * 16
    for g in range(4):
        for h in range(4):
            if closure[g][h] >= INF:
                continue
            for _, cost, t in arcs(h, kind, initial):
                out[g * 4 + t] = min(out[g * 4 + t], closure[g][h] + cost)
    return out


def _back(kinds: list[str], initials: list[str], after: list[int]) -> list[list[int]]:
    """Cost-to-go at every position of a block, given the one after its last row."""
    j = [None] * (len(kinds) + 1)
    j[-1] = list(after)
    for i in range(len(kinds) - 1, -1, -1):
        row = [INF] * 4
        for g in range(4):
            for _, cost, t in arcs(g, kinds[i], initials[i]):
                row[g] = min(row[g], cost + j[i + 1][t], INF)
        j[i] = close(row)
    return j


def _walk(kinds, initials, j, g, last, emit=None) -> tuple[int, str]:
    """Follow the least optimal path from state ``g`` at the block's first row.

    Returns the state at the block's end and the letters; ``emit(letter, index, role)`` is
    called for every edit that writes a row.
    """
    letters, i, n = [], 0, len(kinds)
    if j[0][g] >= INF:
        return -1, ""
    while True:
        if i == n and (not last or g in ACCEPT):
            return g, "".join(letters)
        options = [("I", INSERT, i, _insert_to(g))]
        if i < n:
            options += [(letter, cost, i + 1, t) for letter, cost, t in arcs(g, kinds[i], initials[i])]
        letter, _, i2, t = min((o for o in options if o[1] + j[o[2]][o[3]] == j[i][g]), key=lambda o: o[0])
        if emit is not None and letter != "D":
            emit(letter, i, ROLE[FILL[g]] if letter in "IR" else None)
        letters.append(letter)
        i, g = i2, t


# ---- Spark ---------------------------------------------------------------------------------

def _mp(a: Column, b: Column) -> Column:
    """Min-plus product of two 4 x 4 matrices held as arrays of 16."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(15)),
        lambda k: F.least(
            F.lit(INF),
            F.array_min(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda x: F.get(a, k - k % 4 + x) + F.get(b, x * 4 + k % 4))),
        ),
    )


def _mv(a: Column, v: Column) -> Column:
    return F.transform(
        F.sequence(F.lit(0), F.lit(3)),
        lambda g: F.least(F.lit(INF), F.array_min(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda x: F.get(a, g * 4 + x) + F.get(v, x)))),
    )


def _longs(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("bigint") for v in values])


def damage(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(_c, _t, _r, _x)`` after damage by ``crc32('conv:turn') % 20`` (nulls as one space)."""
    key = F.concat(F.coalesce(F.col(conv).cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col(turn).cast("string"), F.lit(" ")))
    h = F.crc32(key.cast("binary")) % 20
    x = F.coalesce(F.col(text), F.lit(" "))
    r = F.coalesce(F.col(role), F.lit(" "))
    return (
        conversations.select(F.col(conv).alias("_c"), F.col(turn).alias("_t"), r.alias("_r"), x.alias("_x"), h.alias("_h"))
        .filter(F.col("_h") != 0)
        .select(
            "_c", "_t",
            F.when(F.col("_h") == 4, F.lit("user")).otherwise(F.col("_r")).alias("_r"),
            F.when(F.col("_h") == 1, F.lit("")).when(F.col("_h") == 2, F.regexp_replace("_x", "[.!?]", "")).otherwise(F.col("_x")).alias("_x"),
            F.explode(F.when(F.col("_h") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy"),
        )
        .drop("_copy")
    )


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def faults(rows: DataFrame) -> DataFrame:
    """Numbered rows with their block, kind and role initial."""
    numbered = number_within(rows, ["_c"], ["_t", "_r", "_x"], "_p").withColumn("_p", F.col("_p").cast("bigint") - 1)
    numbered = numbered.withColumn("_d", F.sha2("_x", 256))
    firsts = numbered.groupBy("_c", "_r", "_d").agg(F.min("_p").alias("_first")).select(
        F.col("_c").alias("_c2"), F.col("_r").alias("_r2"), F.col("_d").alias("_d2"), "_first"
    )
    last = F.regexp_extract("_x", f"([^\\x20\\x09-\\x0D]){SPACE}*\\z", 1)
    kind = (
        F.when(~F.col("_x").rlike(f"[^\\x20\\x09-\\x0D]"), F.lit(BLANK))
        .when(F.col("_first") < F.col("_p"), F.lit(DUPLICATE))
        .when(~last.isin(*ENDS), F.lit(TRUNC))
        .otherwise(F.lit(PLAIN))
    )
    return cut(
        numbered.join(firsts, _same("_c", "_c2") & (F.col("_r") == F.col("_r2")) & (F.col("_d") == F.col("_d2")))
        .select("_c", "_t", "_r", "_x", "_p", (F.col("_p") / BLOCK).cast("bigint").alias("_b"), kind.alias("_k"),
                F.substring("_r", 1, 1).alias("_i"))
    )


def _row_matrices() -> Column:
    out = F.lit(None)
    for kind in (BLANK, DUPLICATE, TRUNC, PLAIN):
        for initial in ("s", "u", "a", ""):
            hit = (F.col("_k") == kind) & (F.col("_i") == initial if initial else ~F.col("_i").isin("s", "u", "a"))
            out = F.when(hit, _longs(_row_matrix(kind, initial if initial else "?"))).otherwise(out)
    return out


def _double(table: DataFrame, value: str, step: int, combine, rounds: int) -> DataFrame:
    """``rounds`` doubling rounds: block b combines its value with that of block ``b + step * 2^k``."""
    span = 1
    for _ in range(rounds):
        other = table.select(F.col("_c").alias("_c2"), (F.col("_b") - step * span).alias("_b2"), F.col(value).alias("_o"))
        table = cut(
            table.join(other, _same("_c", "_c2") & (F.col("_b") == F.col("_b2")), "left")
            .select("_c", "_b", F.when(F.col("_o").isNull(), F.col(value)).otherwise(combine(F.col(value), F.col("_o"))).alias(value))
        )
        span *= 2
    return table


def _compose(f: Column, g: Column) -> Column:
    """``f`` after ``g``: x -> f[g[x]], -1 where either is -1."""
    return F.transform(F.sequence(F.lit(0), F.lit(3)), lambda x: F.when(F.get(g, x) < 0, F.lit(-1)).otherwise(F.get(f, F.get(g, x))))


def repair(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation ID of the input: ``gaps``, ``blank``, ``duplicate``, ``truncated``,
    ``illegal``, ``cost`` (longs), ``audit``, ``repaired_sha256`` (see the module text)."""
    spark = conversations.sparkSession
    rows = faults(damage(ship(conversations), conv, turn, role, text))

    # 1. block matrices
    blocks = cut(
        rows.withColumn("_m", _row_matrices())
        .groupBy("_c", "_b")
        .agg(F.aggregate(F.array_sort(F.collect_list(F.struct("_p", "_m"))), _longs([0 if i % 5 == 0 else INF for i in range(16)]),
                         lambda acc, x: _mp(acc, x["_m"])).alias("_m"))
    )
    most = blocks.agg(F.max("_b")).first()[0]
    rounds = 0 if most is None else max(0, int(most).bit_length())
    # 2. suffix products: block b holds M_b ... M_last
    suffix = _double(blocks, "_m", 1, _mp, rounds)
    after = suffix.select(F.col("_c").alias("_c2"), (F.col("_b") - 1).alias("_b2"), _mv(F.col("_m"), _longs(END)).alias("_v"))
    ends = cut(
        suffix.join(after, _same("_c", "_c2") & (F.col("_b") == F.col("_b2")), "left")
        .select("_c", "_b", F.coalesce("_v", _longs(END)).alias("_v"), (F.col("_v").isNull()).alias("_last"),
                F.when(F.col("_b") == 0, F.get(_mv(F.col("_m"), _longs(END)), 0)).alias("_cost"))
        .withColumn("_blk", F.monotonically_increasing_id())
    )
    # Python work goes by buckets of many blocks, so a call is not made per block; a bucket
    # holds about BUCKET_BYTES of text, and there are as many buckets as tasks at least.
    size = rows.agg(F.sum(F.length("_x") + 64)).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    def on_block(df: DataFrame, right: DataFrame) -> DataFrame:
        """Rows with their block's values; the block table is broadcast when it is small enough."""
        right = right.withColumnRenamed("_c", "_c2").withColumnRenamed("_b", "_b2")
        if right.count() <= BROADCAST_BLOCKS:
            right = F.broadcast(right)
        return (
            df.join(right, _same("_c", "_c2") & (F.col("_b") == F.col("_b2"))).drop("_c2", "_b2")
            .withColumn("_bucket", F.pmod(F.xxhash64("_blk"), F.lit(buckets)))
        )

    # 3. state maps of the blocks of conversations with more than one
    def maps(pdf):
        out = []
        for blk, group in pdf.groupby("_blk", sort=False):
            group = group.sort_values("_p")
            kinds, initials = list(group["_k"]), list(group["_i"])
            j = _back(kinds, initials, [int(v) for v in group["_v"].iloc[0]])
            out.append((blk, [_walk(kinds, initials, j, g, bool(group["_last"].iloc[0]))[0] for g in range(4)]))
        return pd.DataFrame({"_blk": [b for b, _ in out], "_f": [f for _, f in out]})

    several = cut(ends.filter(~((F.col("_b") == 0) & F.col("_last"))).select("_c", "_b", "_blk", "_v", "_last"))
    fmaps = cut(
        on_block(rows.select("_c", "_b", "_p", "_k", "_i"), several).groupBy("_bucket").applyInPandas(maps, "_blk long, _f array<int>")
        .join(several.select("_blk", "_c", "_b"), "_blk").select("_c", "_b", "_f")
    )
    # 4. prefix compositions: block b holds f_b after ... after f_0
    prefix = _double(fmaps, "_f", -1, _compose, rounds)
    entry = prefix.select(F.col("_c").alias("_c2"), (F.col("_b") + 1).alias("_b2"), F.get("_f", 0).alias("_e"))
    entries = cut(
        ends.join(entry, _same("_c", "_c2") & (F.col("_b") == F.col("_b2")), "left")
        .select("_c", "_b", "_blk", "_v", "_last", F.coalesce("_e", F.lit(0)).alias("_e"))
    )

    # 5. pieces
    def pieces(pdf):
        out = []
        for blk, group in pdf.groupby("_blk", sort=False):
            group = group.sort_values("_p")
            kinds, initials = list(group["_k"]), list(group["_i"])
            roles, texts = list(group["_r"]), list(group["_x"])
            j = _back(kinds, initials, [int(v) for v in group["_v"].iloc[0]])
            lines: list[str] = []

            def emit(letter, i, new_role):
                if letter == "I":
                    lines.append(f"{new_role}:")
                else:
                    lines.append(f"{new_role if letter == 'R' else roles[i]}:{texts[i]}")

            _, letters = _walk(kinds, initials, j, int(group["_e"].iloc[0]), bool(group["_last"].iloc[0]), emit)
            out.append((blk, letters, "\n".join(lines) if lines else None))
        return pd.DataFrame(out, columns=["_blk", "_a", "_s"])

    parts = (
        on_block(rows.select("_c", "_b", "_p", "_k", "_i", "_r", "_x"), entries)
        .groupBy("_bucket").applyInPandas(pieces, "_blk long, _a string, _s string")
        .join(entries.select("_blk", "_c", "_b"), "_blk")
    )
    ordered = F.array_sort(F.collect_list(F.struct("_b", "_a", "_s")))
    joined = parts.groupBy("_c").agg(ordered.alias("_all")).select(
        "_c", F.array_join(F.transform("_all", lambda x: x["_a"]), "").alias("audit"),
        F.sha2(F.array_join(F.transform("_all", lambda x: x["_s"]), "\n"), 256).alias("repaired_sha256"),
    )

    # counts
    nxt = rows.select(F.col("_c").alias("_c2"), (F.col("_p") - 1).alias("_p2"), F.col("_i").alias("_i2"))
    illegal = (
        rows.select("_c", "_p", "_i").join(nxt, _same("_c", "_c2") & (F.col("_p") == F.col("_p2")))
        .groupBy("_c").agg(F.count(F.when(~F.concat("_i", "_i2").isin("su", "ua", "au"), 1)).alias("illegal"))
    )
    counted = rows.groupBy("_c").agg(
        F.coalesce(F.max("_t") - F.min("_t") + 1 - F.countDistinct("_t"), F.lit(0)).alias("gaps"),
        F.count(F.when(F.col("_k") == BLANK, 1)).alias("blank"),
        F.count(F.when(F.col("_k") == DUPLICATE, 1)).alias("duplicate"),
        F.count(F.when(F.col("_k") == TRUNC, 1)).alias("truncated"),
    )
    cost = ends.filter(F.col("_b") == 0).select("_c", "_cost")
    every = conversations.select(F.col(conv).alias("_c")).distinct()

    def attach(left: DataFrame, right: DataFrame) -> DataFrame:
        return left.join(right.withColumnRenamed("_c", "_c2"), _same("_c", "_c2"), "left").drop("_c2")

    out = attach(attach(attach(attach(every, counted), illegal), cost), joined)
    zero = F.lit(0).cast("bigint")
    return out.select(
        F.col("_c").alias(conv),
        *[F.coalesce(F.col(c).cast("bigint"), zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal")],
        F.coalesce(F.col("_cost").cast("bigint"), zero).alias("cost"),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
