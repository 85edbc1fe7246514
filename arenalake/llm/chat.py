"""Chat formatting: a state machine over roles, and text segments with loss flags from a template.

The machine reads the roles of a conversation in order and writes one symbol a turn: the state it is in
now, and whether the turn's text bears loss. Segments and loss flags are made from these symbols. From the first turn
without a transition on, the state is ``out_of_order``; texts of loss roles bear loss there as well.

Everything is a Spark expression. A conversation becomes one string, so its turns meet in one row;
that is the result asked for, and no other grouping happens. Symbols are gathered in blocks of turns, so long
conversations cost no more a turn than short ones.

Defined results: a null text is empty; a null role is the role named by the empty string; a null
``conv_id`` is a conversation of its own; turns sort by number (nulls first), then role, then text,
so repeated rows and ties stay in one fixed order; an empty table gives an empty result. Other
columns of the input are not read, whatever they are called.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


OUT_OF_ORDER = "out_of_order"
BLOCK = 512


@dataclass(frozen=True)
class ChatTemplate:
    """A declarative template.

    A turn is written as ``head`` + role + ``sep`` + text + ``tail``. Each control character in a
    role or text becomes the escape character and a letter, so no marker can occur in either.
    ``transitions`` maps (state, role) to the next state; other turns are out of order.
    """

    head: str = "### "
    sep: str = ": "
    tail: str = " </turn>\n"
    escape: str = "\\"
    letters: dict[str, str] = field(default_factory=lambda: {"\\": "b", "#": "h", "<": "l", ":": "c"})
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    transitions: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "system",
            ("start", "user"): "asked",
            ("system", "user"): "asked",
            ("asked", "assistant"): "answered",
            ("answered", "user"): "asked",
        }
    )
    final: tuple[str, ...] = ("answered",)

    @property
    def states(self) -> list[str]:
        named = [self.start, *(to for _, to in self.transitions.items()), *(state for state, _ in self.transitions)]
        return list(dict.fromkeys([*named, OUT_OF_ORDER]))

    def symbol(self, state: str, loss: bool) -> str:
        """One character for a state and a loss flag."""
        return chr(ord("0") + 2 * self.states.index(state) + loss)

    def __post_init__(self) -> None:
        if self.escape not in self.letters or len(set(self.letters.values())) != len(self.letters):
            raise ValueError("the escape character needs a letter, and letters must differ")
        for marker in (self.head, self.sep, self.tail):
            if not set(marker) & (set(self.letters) - {self.escape}):
                raise ValueError(f"marker {marker!r} needs a control character")


def escaped(text: Column, template: ChatTemplate) -> Column:
    """The escape character goes first, so that the others' escapes stay as they are."""
    order = [template.escape, *(c for c in template.letters if c != template.escape)]
    for char in order:
        text = F.replace(text, F.lit(char), F.lit(template.escape + template.letters[char]))
    return text


def unescaped(text: Column, template: ChatTemplate) -> Column:
    order = [*(c for c in template.letters if c != template.escape), template.escape]
    for char in order:
        text = F.replace(text, F.lit(template.escape + template.letters[char]), F.lit(char))
    return text


def run_machine(roles: Column, template: ChatTemplate) -> Column:
    """The symbols that the machine writes for the turns: an array of one for each."""
    writes = {}
    for state in template.states:
        for (known, role), to in template.transitions.items():
            if known == state:
                symbol = template.symbol(to, role in template.loss_roles)
                for loss in (False, True):  # the machine reads only the state of the last symbol
                    writes[template.symbol(state, loss) + role] = symbol
    table = F.create_map(*(F.lit(x) for pair in writes.items() for x in pair)) if writes else F.lit(None).cast("map<string,string>")
    astray = F.lit(template.symbol(OUT_OF_ORDER, False))
    astray_loss = F.lit(template.symbol(OUT_OF_ORDER, True))

    def step(a: Column, role: Column) -> Column:
        other = F.when(role.isin(*template.loss_roles), astray_loss).otherwise(astray)
        now = F.coalesce(F.try_element_at(table, F.concat(a["last"], role)), other)
        return F.struct(now.alias("last"), F.concat(a["written"], now).alias("written"))

    def block(a: Column, begin: Column) -> Column:
        """Runs over so many turns, and adds what it wrote at once."""
        empty = F.struct(a["last"].alias("last"), F.lit("").alias("written"))
        done = F.aggregate(F.slice(roles, begin, BLOCK), empty, step)
        return F.transform(
            F.array(done), lambda d: F.struct(d["last"].alias("last"), F.concat(a["written"], d["written"]).alias("written"))
        )[0]

    start = F.struct(F.lit(template.symbol(template.start, False)).alias("last"), F.lit("").alias("written"))
    begins = F.when(F.size(roles) > 0, F.sequence(F.lit(1), F.size(roles), F.lit(BLOCK))).otherwise(F.array().cast("array<int>"))
    written = F.aggregate(begins, start, block)["written"]
    return F.filter(F.split(written, ""), lambda c: c != "")


def state_of(symbol: Column, template: ChatTemplate) -> Column:
    names = {template.symbol(state, loss): state for state in template.states for loss in (False, True)}
    return F.element_at(F.create_map(*(F.lit(x) for pair in names.items() for x in pair)), symbol)


def bears_loss(symbol: Column, template: ChatTemplate) -> Column:
    return symbol.isin(*(template.symbol(state, True) for state in template.states))


def format_conversations(turns: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """One row per conversation: ``conv_id, segments, formatted, state, valid``.

    ``segments`` is an array of (text, loss) whose texts concatenate to ``formatted``; ``state`` is the machine's after
    the last turn, and a conversation is valid if it is a final one.
    """
    rows = turns.select(
        "conv_id",
        F.struct(
            F.col("turn").alias("turn"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        ).alias("t"),
    )

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def of_turn(t: Column, symbol: Column) -> Column:
        head = F.concat(F.lit(template.head), escaped(t["role"], template), F.lit(template.sep))
        return F.array(
            segment(head, F.lit(False)),
            segment(escaped(t["text"], template), bears_loss(symbol, template)),
            segment(F.lit(template.tail), F.lit(False)),
        )

    joined = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    run = joined.withColumn("symbols", run_machine(F.transform("turns", lambda t: t["role"]), template))
    states = run.select(
        "conv_id",
        F.flatten(F.zip_with("turns", "symbols", of_turn)).alias("segments"),
        state_of(F.element_at("symbols", -1), template).alias("state"),
    )
    return states.select(
        "conv_id",
        "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        "state",
        F.col("state").isin(*template.final).alias("valid"),
    )


def read_turns(formatted: Column, template: ChatTemplate = ChatTemplate()) -> Column:
    """The turns in a formatted text: an array of (role, text)."""
    def literal(marker: str) -> str:
        return "\\Q" + marker + "\\E"

    pieces = F.split(formatted, literal(template.tail), -1)
    turns = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def one(piece: Column) -> Column:
        both = F.split(F.substr(piece, F.lit(len(template.head) + 1)), literal(template.sep), 2)
        return F.struct(
            unescaped(both[0], template).alias("role"), unescaped(both[1], template).alias("text")
        )

    return F.transform(turns, one)


def loss_text(segments: Column, template: ChatTemplate = ChatTemplate()) -> Column:
    """The text under the loss mask, as it was before it was escaped."""
    under = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(under, lambda s: unescaped(s["text"], template)), "")
