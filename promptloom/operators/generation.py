"""Completions from a plug-in engine, called on Arrow batches.

The engine is the only Python in a job. It is a callable from a list of prompts and a dict
of sampling parameters to a list of outputs in the same order, where an output is a text, a
list of candidate texts, or an exception for that prompt alone. It is loaded once per Python
worker.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from promptloom.constants import BATCH_SAMPLING

Generate = Callable[[list[str], dict[str, Any]], list[Any]]

OUTPUTS = "struct<outputs: array<struct<text: string>>, error: string>"


@dataclass(frozen=True)
class Engine:
    """A named engine; `load` runs once in each Python worker that completes prompts."""

    name: str
    load: Callable[[], Generate]


_loaded: dict[str, Generate] = {}


def _generate_of(engine: Engine) -> Generate:
    if engine.name not in _loaded:
        _loaded[engine.name] = engine.load()
    return _loaded[engine.name]


def batch_sampling(**user: Any) -> dict[str, str]:
    """Sampling parameters of a whole job as JSON texts; the user's win over the defaults."""
    return BATCH_SAMPLING | {k: v if isinstance(v, str) else json.dumps(v) for k, v in user.items()}


def request_sampling(user: Column, defaults: Mapping[str, str | Column]) -> Column:
    """Sampling parameters per request; the user's win, also over a default with an explicit null."""
    given = F.coalesce(user, F.create_map().cast("map<string, string>"))
    entries = [F.lit(v) if isinstance(v, str) else v.cast("string") for v in defaults.values()]
    names = [F.lit(k) for k in defaults]
    default_map = F.map_from_arrays(F.array(*names), F.array(*entries))
    return F.map_concat(F.map_filter(default_map, lambda k, _: ~F.map_contains_key(given, k)), given)


def complete(
    prompt: Column, engine: Engine, sampling: Mapping[str, str] | Column = BATCH_SAMPLING, capture_errors: bool = False
) -> Column:
    """The engine's outputs for each prompt as struct<outputs, error>.

    A failure fails the job, or with `capture_errors` becomes the error of the prompts that
    cause it. `sampling` holds JSON texts: a mapping for the whole job, or a column with one
    JSON object per prompt.
    """
    if isinstance(sampling, Column):

        @F.arrow_udf(OUTPUTS)
        def outputs(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            generate = _generate_of(engine)
            for prompts, parameters in batches:
                yield _complete_batch(generate, prompts.to_pylist(), parameters.to_pylist(), capture_errors)

        return outputs(prompt, sampling)

    whole_job = json.dumps(dict(sampling))

    @F.arrow_udf(OUTPUTS)
    def outputs(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        generate = _generate_of(engine)
        for prompts in batches:
            yield _complete_batch(generate, prompts.to_pylist(), [whole_job] * len(prompts), capture_errors)

    return outputs(prompt)


def first_candidate(outputs: Column) -> Column:
    """The text of the first candidate; null where the engine gave none."""
    return F.try_element_at(outputs, F.lit(1))["text"]


def completion(prompt: Column, engine: Engine, sampling: Mapping[str, str] | Column = BATCH_SAMPLING) -> Column:
    """The first candidate for each prompt; a failure fails the job."""
    return first_candidate(complete(prompt, engine, sampling)["outputs"])


def _complete_batch(generate: Generate, prompts: list, parameters: list, capture_errors: bool) -> pa.Array:
    """One Arrow batch: the engine is called once for each distinct set of parameters."""
    answers: list[list[str] | Exception] = [ValueError("No prompt to complete")] * len(prompts)
    by_parameters: dict[str, list[int]] = {}
    for i, text in enumerate(parameters):
        if prompts[i] is not None:
            by_parameters.setdefault(text, []).append(i)
        elif not capture_errors:
            raise answers[i]
    for text, positions in by_parameters.items():
        sampling = {k: _typed(v) for k, v in json.loads(text).items()}
        given = _answers(generate, [prompts[i] for i in positions], sampling, capture_errors)
        for i, answer in zip(positions, given):
            answers[i] = answer
    failed = [isinstance(answer, Exception) for answer in answers]
    candidates = [[] if bad else answer for bad, answer in zip(failed, answers)]
    texts = pa.array([text for answer in candidates for text in answer], pa.string())
    ends = list(itertools.accumulate(map(len, candidates), initial=0))
    outputs = pa.ListArray.from_arrays(
        pa.array(ends, pa.int32()), pa.StructArray.from_arrays([texts], names=["text"]), mask=pa.array(failed)
    )
    errors = [(str(answer) or type(answer).__name__) if bad else None for bad, answer in zip(failed, answers)]
    return pa.StructArray.from_arrays([outputs, pa.array(errors, pa.string())], names=["outputs", "error"])


def _answers(
    generate: Generate, prompts: list[str], sampling: dict, capture_errors: bool
) -> list[list[str] | Exception]:
    """Candidate texts for each prompt, or what it failed with."""
    try:
        outputs = generate(prompts, dict(sampling))
        if len(outputs) != len(prompts):
            raise ValueError(f"The engine gave {len(outputs)} outputs for {len(prompts)} prompts")
        answers = [_answer(output) for output in outputs]
        failed = next((answer for answer in answers if isinstance(answer, Exception)), None)
        if failed is not None and not capture_errors:
            raise failed
        return answers
    except Exception as error:
        if not capture_errors:
            raise
        if len(prompts) == 1:
            return [error]
        # Halving finds the prompts at fault in few calls when they are few.
        half = len(prompts) // 2
        parts = prompts[:half], prompts[half:]
        return [answer for part in parts for answer in _answers(generate, part, sampling, capture_errors)]


def _answer(output: Any) -> list[str] | Exception:
    if isinstance(output, Exception):
        return output
    return [output] if isinstance(output, str) else list(output)


def _typed(text: str | None) -> Any:
    """The value a JSON text stands for; other text is the value itself."""
    try:
        return json.loads(text) if text is not None else None
    except ValueError:
        return text
