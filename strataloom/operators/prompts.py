"""Prompt texts as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def by_language(language: Column, danish: Column, other: Column) -> Column:
    """The Danish or the other wording."""
    return F.when(language == "da", danish).otherwise(other)


def diversity_sentence(language: Column, topic: Column, mode: Column, persona: Column, embedded: Column) -> Column:
    """What a request is about, how it is put and who puts it; a clause more where it must bring its own text."""
    base = by_language(language, F.format_string("Emne: %s. Form: %s. Afsender: %s.", topic, mode, persona), F.format_string("Topic: %s. Form: %s. Sender: %s.", topic, mode, persona))
    clause = by_language(language, F.lit(" Teksten, der skal bruges, står i beskeden."), F.lit(" The text to work on is part of the message."))
    return F.concat(base, F.when(F.coalesce(embedded, F.lit(False)), clause).otherwise(""))


def request_words(residual: Column, attempt: Column) -> Column:
    """Words to ask a first request for: 30 % of what is left within 50 and 280, less with every attempt, never below 50."""
    first = F.greatest(F.lit(50), F.least(F.lit(280), F.floor(residual * 0.30)))
    return F.greatest(F.lit(50), F.floor(first * F.pow(F.lit(0.72), attempt))).cast("int")


def request_prompt(language: Column, condition: Column, exchanges: Column, most_words: Column, messages: Column | None = None) -> Column:
    """The prompt for a first request, or for a follow-up to ``messages``."""
    limit = by_language(language, F.format_string("Højst %d ord.", most_words), F.format_string("At most %d words.", most_words))
    if messages is None:
        start = by_language(language, F.lit("Skriv den første besked fra en bruger."), F.lit("Write the first message of a user."))
        plan = by_language(language, F.format_string("Samtalen får %d udvekslinger.", exchanges), F.format_string("The conversation will have %d exchanges.", exchanges))
        return F.concat_ws("\n", start, condition, plan, limit)
    start = by_language(language, F.lit("Skriv brugerens næste besked i samtalen."), F.lit("Write the user's next message of the conversation."))
    return F.concat_ws("\n", start, condition, limit, F.to_json(messages))


def answer_control(language: Column, most_words: Column) -> Column:
    """What an assistant is told about the length and end of its answer."""
    return by_language(
        language, F.format_string("Svar på dansk med højst %d ord, og slut med en hel sætning.", most_words), F.format_string("Answer in at most %d words and end with a whole sentence.", most_words)
    )


def user_turn_budget(cap: Column, current: Column, remaining: Column, most: int, least_user: int = 64, least_assistant: int = 192) -> Column:
    """``generation.user_turn_budget`` of a column."""
    reserve = least_assistant + (remaining - 1) * (least_user + least_assistant + 12)
    share = F.floor((cap - current) / F.greatest(F.lit(1), 3 * remaining))
    return F.least(F.lit(most), cap - current - reserve, F.greatest(F.lit(least_user), share)).cast("long")


def answer_turn_budget(cap: Column, prompt: Column, future: Column, most: int, limit: int, least_user: int = 64, least_assistant: int = 192) -> Column:
    """``generation.answer_turn_budget`` of a column."""
    reserve = future * (least_user + 12)
    share = F.floor((cap - prompt - reserve) / (future + 1))
    return F.least(F.lit(most), cap - prompt - reserve - 4, limit - prompt - 4, F.greatest(F.lit(least_assistant), share)).cast("long")


def answer_control_text(language: str, most_words: int) -> str:
    """``answer_control`` of one conversation."""
    return f"Svar på dansk med højst {most_words} ord, og slut med en hel sætning." if language == "da" else f"Answer in at most {most_words} words and end with a whole sentence."


def transcript(messages: Column, upto: Column) -> Column:
    """The first ``upto`` messages as JSON."""
    return F.to_json(F.slice(messages, F.lit(1), upto))
