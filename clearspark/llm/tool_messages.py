"""Messages with tool calls, derived from the turns of a table of plain conversations.

An assistant's turn becomes a call whose arguments hold its whole text, a user's turn the
result of the call before it. What is wrong with some of them follows from the length of
the text alone, so any row can be recomputed by itself.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The tools that may be called, and what their arguments have to be.
SCHEMAS = {
    "search": {
        "type": "object",
        "required": ["query", "limit"],
        "properties": {"query": {"type": "string", "minLength": 1}, "limit": {"type": "integer", "minimum": 1, "maximum": 20}},
        "additionalProperties": False,
    },
    "measure": {
        "type": "object",
        "required": ["value"],
        "properties": {"value": {"type": "number", "minimum": 0}, "unit": {"enum": ["words", "chars"]}, "note": {"type": "string"}},
    },
}


def tool_messages(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with text as JSON; a system turn keeps its plain text.

    By the length n of the text: search when n is even, else measure, and `guess`, which is
    no tool, when n % 17 = 0. The limit is n % 23 (0, 21 and 22 are out of bounds), as text
    when n % 7 = 0; arguments are cut to no JSON when n % 29 = 0. A call waits for the one
    two turns before when n % 3 = 0, and for the next one, which waits for it, when
    n % 31 = 0. A user's result names no call when n % 13 = 0. A null text is an empty one.
    """
    text = F.coalesce("text", F.lit(""))
    n, turn = F.char_length(text), F.col("turn")

    def call(step):
        return F.concat_ws("_", F.lit("call"), F.col("conv_id").cast("string"), (turn + step).cast("string"))

    limit = F.when(n % 7 == 0, F.to_json(F.struct((n % 23).cast("string").alias("limit")))).otherwise(F.to_json(F.struct((n % 23).alias("limit"))))
    query = F.to_json(F.struct(text.alias("query")))
    search = F.concat(F.lit("{"), _inner(query), F.lit(", "), _inner(limit), F.lit("}"))
    measure = F.to_json(F.struct(F.when(n % 5 == 0, "lines").otherwise("words").alias("unit"), (n / 2).alias("value"), text.alias("note")))
    arguments = F.when(n % 2 == 0, search).otherwise(measure)
    arguments = F.when(n % 29 == 0, F.left(arguments, F.lit(9))).otherwise(arguments)
    name = F.when(n % 17 == 0, "guess").when(n % 2 == 0, "search").otherwise("measure")
    after = F.filter(F.array(F.when(n % 3 == 0, call(-2)), F.when(n % 31 == 0, call(2))), lambda x: x.isNotNull())
    asked = F.struct(call(0).alias("id"), name.alias("name"), arguments.alias("arguments"), after.alias("after"))
    told = F.struct(F.when(n % 13 == 0, F.lit("call_none")).otherwise(call(-1)).alias("tool_call_id"), text.alias("content"))
    spoken = F.when(F.col("role") == "assistant", F.to_json(F.struct(F.array(asked).alias("tool_calls")))).when(
        F.col("role") == "user", F.to_json(told)
    )
    role = F.when(F.col("role") == "user", "tool").otherwise(F.col("role"))
    return turns.select("conv_id", "turn", role.alias("role"), F.coalesce(spoken, "text").alias("text"))


def _inner(json):
    return F.substring(json, F.lit(2), F.char_length(json) - 2)
