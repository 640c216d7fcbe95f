"""Notes on rejected or skipped data, as a code with named facts.

A note is one line of text, ``code name=value ...``, so that it can be grouped
by code, put into words in one place (``MEANING``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MEANING = {
    "field_absent": "some message of the topic came without this field",
    "field_shape": "this field's shape varies within the recording",
    "unreadable": "a message could not be turned into numbers, so its topic was left out",
    "no_numbers": "no message of the topic holds numbers",
    "topic_absent": "the recording has no such topic",
    "no_image": "the topic was asked for as video and holds something else",
    "no_clock": "rows have no time, so the table cannot be lined up",
    "column_absent": "the description names a column that the data does not have",
    "column_type": "values of this type cannot be packed",
    "row_length": "a list has another length than the first one",
    "nothing_stored": "the dataset has no rows",
    "width": "a vector has the wrong number of entries",
    "no_number": "an entry is not a number",
    "absent": "a field that every payload needs is absent",
    "unequal": "a list does not go with the positions",
    "empty": "a list has no entries",
    "range": "a number is outside its range",
}


def note(code: str, **facts: Column | str) -> Column:
    """One note; facts are columns or fixed texts, in the order given."""
    if code not in MEANING:
        raise KeyError(code)
    parts = [F.lit(code)]
    for name, value in facts.items():
        shown = value.cast("string") if isinstance(value, Column) else F.lit(str(value))
        parts.append(F.concat(F.lit(f"{name}="), shown))
    return F.concat_ws(" ", *parts)


def code_of(text: Column) -> Column:
    return F.substring_index(text, " ", 1)


def in_words(text: Column) -> Column:
    """The sentence for a note's code, followed by its facts."""
    told = F.create_map(*[F.lit(x) for pair in MEANING.items() for x in pair])
    facts = F.substring(text, F.length(code_of(text)) + 2, F.length(text))
    return F.concat(F.element_at(told, code_of(text)), F.when(F.length(facts) > 0, F.concat(F.lit(": "), facts)).otherwise(""))
