"""Conversations and their rendering as one prompt string."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from promptloom.constants import EXTRACTION_SCHEMA, EXTRACTION_SYSTEM
from promptloom.functions.values import optional_text, present, printed, stripped
from promptloom.schemas import MESSAGES


def conversation(user: Column, system: Column | None = None, assistant: Column | None = None) -> Column:
    """`[system?] user [assistant?]` as an array of messages.

    A null or empty system or assistant text leaves its message out; the user message stays.
    """

    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.cast("string").alias("content"))

    def optional_turn(role: str, content: Column) -> Column:
        return F.when(content.isNull() | (content == ""), no_turn).otherwise(F.array(message(role, content)))

    # Joined arrays stay inside generated code, where a filter over one array would not.
    no_turn = F.array().cast(MESSAGES)
    turns = [F.array(message("user", user))]
    if system is not None:
        turns.insert(0, optional_turn("system", system))
    if assistant is not None:
        turns.append(optional_turn("assistant", assistant))
    return F.concat(*turns).cast(MESSAGES)


@dataclass(frozen=True)
class ChatLayout:
    """What a chat template writes around each message: a prefix and a suffix for its role.

    `roles` holds the prefix and suffix of single roles. Other roles have the common ones,
    where `{role}` in the prefix stands for the role's name.
    """

    # The defaults are the ChatML layout.
    prefix: str = "<|im_start|>{role}\n"
    suffix: str = "<|im_end|>\n"
    generation_prompt: str = "<|im_start|>assistant\n"
    roles: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    # Written in front of the conversation.
    begin: str = ""
    # System text written first when the conversation opens with a user turn.
    opening_system: str | None = None
    # Ends the last turn when it is the assistant's.
    final_suffix: str | None = None
    trim_content: bool = False

    def _around(self, role: str) -> tuple[str, str]:
        return self.roles.get(role, (self.prefix.replace("{role}", role), self.suffix))

    def _opening(self) -> str:
        before, after = self._around("system")
        return "" if self.opening_system is None else before + self.opening_system + after

    def _content(self, content: Column) -> Column:
        return stripped(printed(content)) if self.trim_content else printed(content)

    def _prefix_of(self, role: Column) -> Column:
        pieces = [F.lit(piece) for piece in self.prefix.split("{role}")]
        named = [column for piece in pieces for column in (role, piece)][1:]
        prefix = F.concat(*named)
        for name, (before, _) in self.roles.items():
            prefix = F.when(role == name, F.lit(before)).otherwise(prefix)
        return prefix

    def _suffix_of(self, role: Column, is_last: Column) -> Column:
        suffix = F.lit(self.suffix)
        for name, (_, after) in self.roles.items():
            suffix = F.when(role == name, F.lit(after)).otherwise(suffix)
        if self.final_suffix is None:
            return suffix
        return F.when((role == "assistant") & is_last, F.lit(self.final_suffix)).otherwise(suffix)

    def render(self, messages: Column, generate: bool = True) -> Column:
        """Any messages column as one string, with the generation prompt if asked."""

        def turn(message: Column, index: Column) -> Column:
            role, is_last = message["role"], index == F.size(messages) - 1
            parts = [self._prefix_of(role), self._content(message["content"]), self._suffix_of(role, is_last)]
            if self._opening():
                parts.insert(0, F.when((index == 0) & (role == "user"), F.lit(self._opening())).otherwise(""))
            return F.concat(*parts)

        turns = F.array_join(F.transform(messages, turn), "")
        return F.concat(F.lit(self.begin), turns, F.lit(self.generation_prompt if generate else ""))

    def prompt(self, user: Column, system: Column | None = None) -> Column:
        """`[system?] user` rendered for generation.

        The same text as `render(conversation(user, system))` without building the array, so
        the expression stays inside generated code.
        """
        head, tail = self._around_prompt(system)
        return F.concat(head, self._content(user), tail)

    def pieces(self, system: Column | None = None) -> Column:
        """What `prompt` writes before and after the user's content; see `pieces_around`."""
        return F.array(*self._around_prompt(system))

    def _around_prompt(self, system: Column | None) -> tuple[Column, Column]:
        before_user, after_user = self._around("user")
        tail = F.lit(after_user + self.generation_prompt)
        if system is None:
            return F.lit(self.begin + self._opening() + before_user), tail
        system = present(optional_text(system))
        before, after = self._around("system")
        system_turn = F.concat(F.lit(before), self._content(system), F.lit(after))
        first = F.when(system.isNotNull(), system_turn).otherwise(F.lit(self._opening()))
        return F.concat(F.lit(self.begin), first, F.lit(before_user)), tail


CHATML = ChatLayout()

# The extraction layout.
EXTRACTION = ChatLayout(
    prefix="<|im_start|>{role}\n",
    suffix="\n<|im_end|>\n",
    generation_prompt="<|im_start|>assistant",
    roles={
        "user": (f"<|im_start|>user\n# Template:\n{EXTRACTION_SCHEMA}\n# Input:\n", "\n<|im_end|>\n"),
    },
    opening_system=EXTRACTION_SYSTEM,
    final_suffix="\n<|endoftext|>",
    trim_content=True,
)

# A `chat_template` value names one of these, or one the caller adds.
LAYOUTS = {"chatml": CHATML, "extraction": EXTRACTION}
