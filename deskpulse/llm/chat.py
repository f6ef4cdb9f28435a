"""Chat formatting in Spark expressions.

A conversation becomes one string. Adjacent turns of a role form a block,
``<|im_start|>role`` line, texts with ``<|im_sep|>`` between them, ``<|im_end|>`` line,
so every turn can be read back. A control string inside a text or role gets a backslash
after its first character; one that has backslashes there already gets one more.
"""

from pyspark.sql import functions as F

from deskpulse.llm.common import column

HEAD, SEPARATOR, TAIL = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
# Fixed strings that tokenizers or templates may take for control strings.
REST = r"\|im_start\||\|im_end\||\|im_sep\||\|endoftext\||/?s|</?SYS>"
ESCAPE = rf"(<\\*)((?:{REST})>)|(\[\\*)(/?INST\])"
UNESCAPE = rf"(<\\*)\\((?:{REST})>)|(\[\\*)\\(/?INST\])"


def escaped(text):
    """A text without control strings; ``unescaped`` is its inverse."""
    return F.regexp_replace(text, F.lit(ESCAPE), F.lit(r"$1$3\\$2$4"))


def unescaped(text):
    return F.regexp_replace(text, F.lit(UNESCAPE), F.lit(r"$1$3$2$4"))


def _role_written(role):
    """A role on one line."""
    one_line = F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))
    return escaped(one_line)


def _role_read(text):
    return F.replace(F.replace(unescaped(text), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def _merged(turns):
    """Blocks (role, texts) of adjacent turns of one role."""
    block = "array<struct<role:string,texts:array<string>>>"

    def add(blocks, turn):
        last = F.element_at(blocks, -1)
        new = F.array(F.struct(turn["role"].alias("role"), F.array(turn["text"]).alias("texts")))
        longer = F.array(
            F.struct(
                last["role"].alias("role"),
                F.concat(last["texts"], F.array(turn["text"])).alias("texts"),
            )
        )
        same = (F.size(blocks) > 0) & (F.try_element_at(blocks, F.lit(-1))["role"] == turn["role"])
        return F.when(
            same, F.concat(F.slice(blocks, F.lit(1), F.size(blocks) - 1), longer)
        ).otherwise(F.concat(blocks, new))

    return F.aggregate(turns, F.array().cast(block), add)


def _segments(block, learned):
    """A block as (s, loss) segments: header, texts with separators, tail."""
    plain = F.lit(False)
    loss = block["role"].isin(*learned)
    texts = F.transform(
        block["texts"],
        lambda text, i: F.array(
            F.struct(F.when(i > 0, SEPARATOR).otherwise("").alias("s"), plain.alias("loss")),
            F.struct(escaped(text).alias("s"), loss.alias("loss")),
        ),
    )
    head = F.concat(F.lit(HEAD), _role_written(block["role"]), F.lit("\n"))
    return F.concat(
        F.array(F.struct(head.alias("s"), plain.alias("loss"))),
        F.flatten(texts),
        F.array(F.struct(F.lit(TAIL).alias("s"), plain.alias("loss"))),
    )


def _spans(segments):
    """(start, length) in code points of the segments under the loss mask."""
    zero = F.struct(
        F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")
    )

    def add(state, segment):
        length = F.char_length(segment["s"])
        span = F.array(F.struct(state["at"].alias("start"), length.alias("length")))
        return F.struct(
            (state["at"] + length).alias("at"),
            F.when(segment["loss"], F.concat(state["spans"], span))
            .otherwise(state["spans"])
            .alias("spans"),
        )

    return F.aggregate(segments, zero, add)["spans"]


def format_chats(
    turns, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text", learned=("assistant",)
):
    """One row per conversation: id, ``formatted``, ``loss_spans``.

    Turns are ordered by number (nulls first), ties by role and text; repeated rows are
    turns of their own. Null texts and roles count as empty ones, a null id is a
    conversation of its own. ``loss_spans`` are (start, length) in code points of
    ``formatted``, one for each text of a ``learned`` role. An empty table gives no rows.
    """
    empty = F.lit("")
    turn = F.struct(
        column(turn_col).alias("turn"),
        F.coalesce(column(role_col), empty).alias("role"),
        F.coalesce(column(text_col), empty).alias("text"),
    )
    chats = turns.select(column(conv_col).alias("conv"), turn.alias("turn"))
    chats = chats.groupBy("conv").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    blocks = chats.select("conv", F.explode(F.array(_merged(F.col("turns")))).alias("blocks"))
    parts = F.flatten(F.transform("blocks", lambda b: _segments(b, learned)))
    segments = blocks.select("conv", F.explode(F.array(parts)).alias("segments"))
    return segments.select(
        F.col("conv").alias(conv_col),
        F.array_join(F.transform("segments", lambda s: s["s"]), "").alias("formatted"),
        _spans(F.col("segments")).alias("loss_spans"),
    )


def read_turns(formatted):
    """The turns (role, text) of a formatted conversation."""
    blocks = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda b: b != "")

    def of_block(block):
        written = F.substring_index(block, "\n", 1)
        role = _role_read(F.substr(written, F.lit(len(HEAD) + 1)))
        texts = F.split(F.substr(block, F.char_length(written) + 2), r"<\|im_sep\|>")
        return F.transform(
            texts, lambda t: F.struct(role.alias("role"), unescaped(t).alias("text"))
        )

    return F.flatten(F.transform(blocks, of_block))


def learned_text(formatted, spans):
    """The text under the loss mask, unescaped, one span after the other."""
    return F.array_join(
        F.transform(
            spans, lambda s: unescaped(F.substr(formatted, s["start"] + 1, s["length"]))
        ),
        "",
    )


def digests(formatted, conv_col="conv_id"):
    """Per conversation what can be read back from the output of ``format_chats``."""
    turns = formatted.select(
        column(conv_col).alias("conv"),
        "formatted",
        F.explode(
            F.array(
                F.struct(
                    read_turns(F.col("formatted")).alias("turns"),
                    learned_text(F.col("formatted"), F.col("loss_spans")).alias("learned"),
                )
            )
        ).alias("read"),
    )
    lines = F.transform(
        "read.turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    return turns.select(
        F.col("conv").alias(conv_col),
        F.size("read.turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("read.learned").cast("long").alias("loss_chars"),
        F.sha2("read.learned", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
