"""Settings of a run, steps, and the route that a set of witnesses takes."""

from __future__ import annotations

from dataclasses import dataclass, fields

from colloquy.functions import fixed

STEPS = ("download", "recognise", "ensemble", "diarize", "slides", "merge", "markdown", "summarize", "analysis")


@dataclass(frozen=True)
class Config:
    """One run; the limits are those of an adjudicator's calls."""

    title: str = ""
    chunk_words: int = fixed.CHUNK_WORDS
    context_words: int = fixed.CONTEXT_WORDS
    cluster_diffs: int = fixed.CLUSTER_DIFFS
    intro_words: int = fixed.INTRO_WORDS
    tries: int = 5
    wait_seconds: float = 5.0
    timeout_seconds: float = 120.0
    speakers: tuple[str, ...] = ()
    steps: tuple[str, ...] | None = None
    skip_existing: bool = True
    dry_run: bool = False
    adjudicate: bool = True

    def __post_init__(self):
        if wrong := sorted(set(self.steps or ()) - set(STEPS)):
            raise ValueError(f"unknown steps: {', '.join(wrong)}")
        for f in fields(self):
            if f.name.endswith(("_words", "_diffs")) and getattr(self, f.name) < 1:
                raise ValueError(f"{f.name} must be positive")

    def runs(self, step: str) -> bool:
        """Whether a step is asked for; all are if none is named."""
        return self.steps is None or step in self.steps

    def skips(self, fresh: bool) -> bool:
        """Whether a step's work is left out: its output is fresh and may be kept, or nothing is to be done at all."""
        return self.dry_run or self.skip_existing and fresh


def ensemble_route(models: list[str], adjudicate: bool = True) -> tuple[str, str | None]:
    """(route, base model): nothing for less than two models' texts, the base's text alone without an adjudicator."""
    rank = {m: i for i, m in enumerate(fixed.MODEL_ORDER)}
    base = min(models, key=lambda m: (rank.get(m, len(rank)), m)) if models else None
    return ("none" if len(models) < 2 else "resolve" if adjudicate else "base", base)


def merge_route(sources: list[str], external_form: str | None = None, diarized_form: str | None = None) -> str:
    """How sources are merged: structured by the external text's form, else by that of the diarized text; a single
    source with a diarized text gives that text as it is; without a form at least two are merged flat."""
    if external_form:
        return "structured:external"
    if diarized_form:
        return "structured:diarized" if len(sources) > 1 else "diarized"
    return "flat" if len(sources) > 1 else "none"
