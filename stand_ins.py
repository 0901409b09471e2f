"""Deterministic stand-ins for a model, for tests, registered queries and measurements."""

from __future__ import annotations

from promptloom.operators.generation import Engine

# A prompt with this text fails in the strict engine.
FAILING = "***"


def _digest() -> Engine:
    def load():
        from hashlib import md5

        return lambda prompts, sampling: ["gen:" + md5(prompt.encode()).hexdigest() for prompt in prompts]

    return Engine("digest", load)


def _strict(marker: str) -> Engine:
    def load():
        from hashlib import md5

        def generate(prompts, sampling):
            for prompt in prompts:
                if marker in prompt:
                    raise ValueError(f"Prompt of {len(prompt)} characters holds {marker}")
            return [["gen:" + md5(prompt.encode()).hexdigest(), "second candidate"] for prompt in prompts]

        return generate

    return Engine("strict", load)


def _sampled() -> Engine:
    def load():
        from hashlib import md5

        return lambda prompts, sampling: [f"{sampling['max_tokens']}:{md5(p.encode()).hexdigest()}" for p in prompts]

    return Engine("sampled", load)


# Loaders are nested functions, which go to executors by value, as this file is not in the package.
# Completes a prompt with its digest.
DIGEST = _digest()
# Gives two candidates, and fails on prompts with a marker.
STRICT = _strict(FAILING)
# Puts a sampling parameter in front of the digest.
SAMPLED = _sampled()
