"""Chat formatting: records of different layouts to canonical turns to one marked text."""

from pyspark.sql import functions as F

from feedstream.llm.common import sha256

# Declared layouts. paths: every nested field path; turns: where the turns are, either a list of
# messages (list, role field, text field) or fixed fields with their roles.
LAYOUTS = {
    "messages": {"paths": ["messages[].content", "messages[].role"], "list": ("messages", "role", "content")},
    "conversations": {"paths": ["conversations[].from", "conversations[].value"],
                      "list": ("conversations", "from", "value")},
    "prompt": {"paths": ["completion", "prompt"], "fields": [("user", ["prompt"]), ("assistant", ["completion"])]},
    "instruction": {"paths": ["input", "instruction", "output"],
                    "fields": [("user", ["instruction", "input"]), ("assistant", ["output"])]},
    "instruction_only": {"paths": ["instruction", "output"],
                         "fields": [("user", ["instruction"]), ("assistant", ["output"])]},
    "turn": {"paths": ["content", "role"], "list": (None, "role", "content")},
}
# Names of roles in other layouts.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant"}
# Control characters of the template and their escapes; the backslash is first out and last back.
ESCAPES = [("\\", "\\b"), ("<", "\\l"), (">", "\\g"), ("#", "\\h")]
TURNS = "array<struct<role:string,text:string>>"


def fingerprint(paths):
    return F.xxhash64(F.array_join(paths, "|"))


def field_paths(record):
    """Sorted nested field paths of a JSON record; those of a list are its first element's."""
    def below(name):
        first = F.call_function("get_json_object", record, F.concat(F.lit("$."), name, F.lit("[0]")))
        return F.coalesce(
            F.transform(F.json_object_keys(first), lambda k: F.concat(name, F.lit("[]."), k)), F.array(name))

    return F.array_sort(F.flatten(F.transform(F.json_object_keys(record), below)))


def escape(text):
    for mark, code in ESCAPES:
        text = F.replace(text, F.lit(mark), F.lit(code))
    return text


def unescape(text):
    for mark, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(mark))
    return text


def layout_turns(layout, record):
    if "fields" in layout:
        names = [n for _, fields in layout["fields"] for n in fields]
        parsed = F.from_json(record, ", ".join(f"`{n}` string" for n in names))

        def joined(fields):
            parts = F.filter(F.array(*[F.coalesce(parsed[n], F.lit("")) for n in fields]), lambda x: x != "")
            return F.array_join(parts, "\n")

        return F.array(*[F.struct(F.lit(role).alias("role"), joined(fields).alias("text"))
                         for role, fields in layout["fields"]]).cast(TURNS)
    place, role, text = layout["list"]
    one = f"struct<`{role}`:string,`{text}`:string>"
    if place:
        found = F.from_json(record, f"`{place}` array<{one}>")[place]
    else:
        found = F.array(F.from_json(record, f"`{role}` string, `{text}` string"))
    names = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])

    def turn(t):
        given = F.coalesce(t[role], F.lit(""))
        return F.struct(F.coalesce(names[given], given).alias("role"), F.coalesce(t[text], F.lit("")).alias("text"))

    return F.transform(found, turn)


def canonical(records, record_col="record"):
    """records with layout (name or null) and turns. The hash of a record's field paths selects the
    layout's declared mapping. Null or empty texts and roles become ''. A record of no declared
    layout, null or not JSON gets a null layout and no turns."""
    key = fingerprint(field_paths(F.col(record_col)))
    name, turns = F.lit(None).cast("string"), F.array().cast(TURNS)
    for label, layout in LAYOUTS.items():
        here = F.col("_llm_layout") == fingerprint(F.array(*[F.lit(p) for p in layout["paths"]]))
        name = F.when(here, F.lit(label)).otherwise(name)
        turns = F.when(here, layout_turns(layout, F.col(record_col))).otherwise(turns)
    kept = [c for c in records.columns if c not in ("layout", "turns")]
    return records.select(*kept, key.alias("_llm_layout")).select(
        *kept, name.alias("layout"), F.coalesce(turns, F.array().cast(TURNS)).alias("turns"))


def formatted(conversations):
    """conversations (turns) with `formatted` and `loss`, the spans of the formatted text (start,
    end, in code points) that a model is trained on: each assistant text.

    A turn is <role>text</turn> and a newline. Texts and roles are escaped, so the marks occur
    nowhere else and the template can be read back exactly. No turns: an empty text, no spans.
    """
    parts = F.transform("turns", lambda t: F.struct(
        escape(t["role"]).alias("role"), escape(t["text"]).alias("text"), (t["role"] == "assistant").alias("loss")))
    marked = F.transform(parts, lambda t: F.concat(F.lit("<"), t["role"], F.lit(">"), t["text"], F.lit("</turn>\n")))

    def step(acc, t):
        start = acc["at"] + F.char_length(t["role"]) + 2
        end = start + F.char_length(t["text"])
        return F.struct((end + 8).alias("at"), F.concat(acc["spans"], F.when(
            t["loss"], F.array(F.struct(start.alias("start"), end.alias("end"))))
            .otherwise(F.array().cast("array<struct<start:int,end:int>>"))).alias("spans"))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    kept = [c for c in conversations.columns if c not in ("formatted", "loss")]
    return conversations.select(
        *kept, F.array_join(marked, "").alias("formatted"), F.aggregate(parts, zero, step)["spans"].alias("loss"))


def read_turns(text):
    """Turns of a formatted text."""
    pieces = F.filter(F.split(text, "</turn>\n", -1), lambda p: p != "")
    return F.transform(pieces, lambda p: F.struct(
        unescape(F.substring_index(F.substring(p, 2, 2**31 - 1), ">", 1)).alias("role"),
        unescape(F.substring_index(p, ">", -1)).alias("text")))


def read_loss(text, spans):
    """The trained-on texts under the loss spans, one after the other."""
    return F.array_join(F.transform(
        spans, lambda s: unescape(F.substring(text, s["start"] + 1, s["end"] - s["start"]))), "")


def as_records(rows):
    """(conv_id, record): the rows of each conversation, by turn (ties by role, text), as a JSON
    record: a prompt and its completion, messages where a system turn leads, else from/value."""
    turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")))).alias("t"))
    roles = F.transform("t", lambda x: x["role"])
    pair = roles == F.array(F.lit("user"), F.lit("assistant"))
    leads = F.element_at(roles, 1) == "system"
    return turns.select("conv_id", F.when(pair, F.to_json(F.struct(
        F.col("t")[0]["text"].alias("prompt"), F.col("t")[1]["text"].alias("completion"))))
        .when(leads, F.to_json(F.struct(F.transform("t", lambda x: F.struct(
            x["role"].alias("role"), x["text"].alias("content"))).alias("messages"))))
        .otherwise(F.to_json(F.struct(F.transform("t", lambda x: F.struct(
            x["role"].alias("from"), x["text"].alias("value"))).alias("conversations")))).alias("record"))


def op7(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"))
    done = formatted(canonical(as_records(rows.unionByName(extra))))
    turns, loss = F.col("read"), F.col("trained")
    return done.select("conv_id", "layout", "formatted", read_turns(F.col("formatted")).alias("read"),
                       read_loss(F.col("formatted"), F.col("loss")).alias("trained")).select(
        "conv_id", F.size(turns).cast("long").alias("n_turns"),
        sha256(F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"), sha256(loss).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"), "layout")


ORACLE_OP7 = r"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
c AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
    CAST(sum(length(regexp_replace(role || text, '[\\<>#]', 'xx', 'g')) + 10) AS BIGINT) AS formatted_chars,
    list(role ORDER BY turn, role, text) AS roles
  FROM r GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
  sha256(loss) AS loss_sha256, formatted_chars,
  CASE WHEN roles = ['user', 'assistant'] THEN 'prompt' WHEN roles[1] = 'system' THEN 'messages'
       ELSE 'conversations' END AS layout
FROM c
"""
