"""Chat templates and token counts of conversations."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

#: A text that no template and no message holds.
SENTINEL = "\x02strataloom\x03"


@dataclass(frozen=True)
class ChatTemplate:
    """How a model writes messages: what stands around a message of each role, and before an answer."""

    around: dict[str, tuple[str, str]]
    before_answer: str

    @classmethod
    def derived(cls, render: Callable[[list[dict], bool], str], roles: tuple[str, ...] = ("system", "user", "assistant")) -> ChatTemplate:
        """The template of a function that renders messages, found by rendering a sentinel in each role.

        Raises where the function changes or repeats a message, or where messages
        do not follow each other as they stand alone.
        """
        around = {}
        for role in roles:
            parts = render([{"role": role, "content": SENTINEL}], False).split(SENTINEL)
            if len(parts) != 2:
                raise ValueError(f"the template does not keep a message of {role}")
            around[role] = (parts[0], parts[1])
        user = [{"role": "user", "content": SENTINEL}]
        closed, opened = render(user, False), render(user, True)
        if not opened.startswith(closed):
            raise ValueError("the template changes a message before an answer")
        out = cls(around, opened[len(closed) :])
        both = [{"role": role, "content": f"{SENTINEL}{role}"} for role in roles if role != "system"]
        if out.rendered(both) != render(both, False):
            raise ValueError("the template does not write messages one after another")
        return out

    def rendered(self, messages: list[dict], answer: bool = False) -> str:
        """Messages as the model reads them, with the beginning of an answer or not."""
        text = "".join(f"{self.around[m['role']][0]}{m['content']}{self.around[m['role']][1]}" for m in messages)
        return text + self.before_answer if answer else text

    def open_user(self, messages: list[dict], system: str | None = None) -> str:
        """The text after which a model writes the next user message itself."""
        head = [{"role": "system", "content": system}] if system else []
        return self.rendered(head + messages) + self.around["user"][0]

    def boundary(self) -> str:
        """What ends a user message: a written one is cut there."""
        return self.around["user"][1]


def chat_tokens(messages: list[dict], template: ChatTemplate, encode: Callable[[str], list[int]], answer: bool = False) -> list[int]:
    """The token ids of a conversation."""
    return encode(template.rendered(messages, answer))


def counter(template: ChatTemplate, encode: Callable[[str], list[int]]) -> Callable[[list[dict]], int]:
    """Counts the tokens of conversations, markers included."""
    return lambda messages: len(chat_tokens(messages, template, encode))
