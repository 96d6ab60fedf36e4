"""Chat formatting as relational algebra: Spark expressions only, no Python on the executors.

A turn is written `<|turn|>role<|text|>text<|end|>`. Inside roles and texts `&` and `<` are written `&amp;` and `&lt;`, so no
control string, of this or of another template, can be read as a mark, and the writing is reversible.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Between texts of adjacent turns of one role, which share a frame.
NEXT = "<|next|>"
LEARNED_ROLE = "assistant"


def escape(text: Column) -> Column:
    """Null is empty."""
    return F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", learned_role: str = LEARNED_ROLE) -> DataFrame:
    """One row per conversation: conv_id, formatted string, loss array<struct<start long, length long>>.

    Turns stand by turn number (null first), repeated numbers by role and text; rows that repeat a whole turn are turns of their own.
    A null role or text is empty, a null conversation id a conversation. Adjacent turns of one role share a frame, their
    texts apart by a mark. loss: where, in code points from 0, the escaped texts of the learned role lie. Other columns take no
    part; an empty table gives an empty result. A conversation is one string and so one row.
    """
    turn = F.struct(F.col(turn_col).alias("turn"), escape(F.col(role_col)).alias("role"), escape(F.col(text_col)).alias("text"))
    sorted_turns = turns.groupBy(F.col(conv_col).alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    # Frames: where the role differs from the turn before, a frame begins; it reaches to the next beginning.
    begins = sorted_turns.withColumn("begins", F.expr("filter(sequence(1, size(turns)), i -> i = 1 or turns[i - 1].role <> turns[i - 2].role)"))
    frames = begins.select(
        "conv_id",
        F.expr("transform(begins, (b, k) -> slice(turns, b, coalesce(get(begins, k + 1), size(turns) + 1) - b))").alias("frames"),
    ).select("conv_id", F.expr("transform(frames, f -> struct(f[0].role as role, transform(f, t -> t.text) as texts))").alias("frames"))
    head = f"concat('{TURN}', f.role, '{TEXT}')"
    whole = F.expr(f"array_join(transform(frames, f -> concat({head}, array_join(f.texts, '{NEXT}'), '{END}')), '')")
    # Cut into the stretches that carry loss or not, in order; a running sum of their lengths gives the places.
    pieces = F.expr(
        f"""flatten(transform(frames, f -> concat(
              array(struct(length({head}) as n, false as learned)),
              flatten(transform(f.texts, (t, k) -> array(
                struct(if(k = 0, 0, {len(NEXT)}) as n, false as learned), struct(length(t) as n, f.role = :role as learned)))),
              array(struct({len(END)} as n, false as learned)))))""".replace(":role", "'" + learned_role.replace("\\", "\\\\").replace("'", "\\'") + "'")
    )
    placed = frames.select("conv_id", whole.alias("formatted"), pieces.alias("pieces"))
    run = F.expr(
        """aggregate(pieces, struct(0L as at, cast(array() as array<struct<start: bigint, length: bigint>>) as loss),
             (a, p) -> struct(a.at + p.n as at, if(p.learned, array_append(a.loss, struct(a.at as start, cast(p.n as bigint) as length)), a.loss) as loss), a -> a.loss)"""
    )
    return placed.select("conv_id", "formatted", run.alias("loss"))


def read_back(chats: DataFrame) -> DataFrame:
    """conv_id, turns array<struct<role, text>>, loss_texts array<string>, both unescaped, from formatted and loss alone."""
    framed = F.expr(f"transform(filter(split(formatted, '{TURN}', -1), (x, k) -> k > 0), x -> substring_index(x, '{END}', 1))".replace("|", "[|]", 2).replace("substring_index(x, '<[|]", "substring_index(x, '<|"))
    frames = chats.select("conv_id", "formatted", "loss", framed.alias("frames"))
    turns = F.expr(
        f"""flatten(transform(frames, x -> transform(split(substring(x, instr(x, '{TEXT}') + {len(TEXT)}), '<[|]next[|]>', -1),
              t -> struct(substring_index(x, '{TEXT}', 1) as role, t as text))))"""
    )
    plain = lambda x: f"replace(replace({x}, '&lt;', '<'), '&amp;', '&')"
    return frames.select("conv_id", "formatted", "loss", turns.alias("turns")).select(
        "conv_id",
        "formatted",
        F.expr(f"transform(turns, t -> struct({plain('t.role')} as role, {plain('t.text')} as text))").alias("turns"),
        F.expr(f"transform(loss, m -> {plain('substring(formatted, cast(m.start + 1 as int), cast(m.length as int))')})").alias("loss_texts"),
    )


def chat_digests(turns: DataFrame) -> DataFrame:
    """What the formatted strings say when read back: counts and digests per conversation."""
    found = read_back(format_chats(turns))
    loss = F.array_join("loss_texts", "")
    return found.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.expr("array_join(transform(turns, t -> concat(t.role, '\\n', t.text, '\\n')), '')"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
