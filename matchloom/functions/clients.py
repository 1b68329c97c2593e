"""What a run asks of language models and embedders, and deterministic stand-ins that need no network."""

from __future__ import annotations

import hashlib
import json
import math
import re
import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Protocol

from matchloom.config import ModelSettings
from matchloom.functions.similarity import token_set_ratio
from matchloom.functions.text import json_safe


class LanguageModel(Protocol):
    """Called in batches on executors; an implementation must be picklable, and retry and pace its own requests."""

    def describe(self, columns: Sequence[dict]) -> list[str]: ...

    def judge_columns(self, pairs: Sequence[dict]) -> list[tuple[str, str]]: ...

    def translate(self, values: Sequence[str]) -> list[str]: ...

    def judge_rows(self, pairs: Sequence[tuple[str, str]]) -> list[tuple[str, str]]: ...

    def choose_transform(self, enrichment: Sequence[str], master: Sequence[str], hits: dict[str, int]) -> str:
        """The name of a transform, a key of ``hits``: after each, so many of the frequent enrichment values are frequent master values."""
        ...


class Embedder(Protocol):
    width: int

    def embed(self, texts: Sequence[str]) -> list[list[float]]: ...


def parse_decision(reply: str) -> tuple[str, str]:
    """The first line as Yes, No or Maybe, whatever its quotes and case, and the rest as the reason; anything else is No."""
    head, _, rest = reply.strip().partition("\n")
    word = re.sub(r"[^a-z]", "", head.lower())
    return {"yes": "Yes", "maybe": "Maybe"}.get(word, "No"), rest.strip()


def strip_fence(text: str) -> str:
    """A reply without the code fence around it."""
    return re.sub(r"^\s*```[a-z]*\s*|\s*```\s*$", "", text)


def parse_object(reply: str) -> dict:
    """The JSON object of a reply, whatever fence or words stand around it; empty if there is none."""
    text = strip_fence(reply)
    for candidate in (text, text[text.find("{") : text.rfind("}") + 1]):
        try:
            found = json.loads(candidate)
        except ValueError:
            continue
        if isinstance(found, dict):
            return found
    return {}


def parse_judgement(reply: str) -> tuple[str, str]:
    """Decision and justification of a structured reply, or of one in plain lines."""
    found = parse_object(reply)
    if "decision" not in found:
        return parse_decision(strip_fence(reply))
    decision = parse_decision(str(found["decision"]))[0]
    return decision, str(found.get("justification") or "")


#: What a column without a description of its own gets.
UNDESCRIBED = "No description available."


@dataclass(frozen=True)
class PromptModel:
    """A language model behind one function: ``complete(prompt, settings)`` sends a prompt with the hyper-parameters and returns the reply.

    The function must be picklable. A call that raises is tried again ``retries`` times, after ``wait`` seconds, twice that, and so on.
    Replies are structured: JSON objects, read whatever stands around them; what can't be read is No, or no description.
    """

    complete: Callable[[str, ModelSettings], str]
    settings: ModelSettings = field(default_factory=ModelSettings)
    retries: int = 3
    wait: float = 1.0
    #: A folder that all executors reach: replies are kept there and no prompt is asked twice (``operators.replies``).
    store: str | None = None
    #: Calls at once of one task, and, with a store, of all tasks together.
    threads: int = 8
    in_flight: int = 64

    def ask(self, prompt: str) -> str:
        for k in range(self.retries + 1):
            try:
                return self.complete(prompt, self.settings) or ""
            except Exception:
                if k == self.retries:
                    raise
                time.sleep(self.wait * 2**k)
        return ""

    def ask_each(self, prompts: Sequence[str]) -> list[str]:
        """The replies in order, ``threads`` calls at once."""
        with ThreadPoolExecutor(max(1, min(self.threads, len(prompts)))) as pool:
            return list(pool.map(self.ask, prompts))

    def describe(self, columns: Sequence[dict]) -> list[str]:
        """One call for each dataset."""
        by_dataset: dict[str, dict] = {}
        for c in columns:
            shown = [json_safe(v, c["data_type"]) for v in c["example_values"] or []]
            by_dataset.setdefault(c["dataset"], {})[c["column_name"]] = {"data_type": c["data_type"], "examples": shown}
        names, prompts = list(by_dataset), []
        for name, meta in by_dataset.items():
            prompts.append(f"Describe in one sentence what each column of the dataset {name} holds. Reply with one JSON object, from column name to description.\n{json.dumps(meta, ensure_ascii=False)}")
        told = {name: parse_object(reply) for name, reply in zip(names, self.ask_each(prompts), strict=True)}
        return [str(told[c["dataset"]].get(c["column_name"]) or UNDESCRIBED) for c in columns]

    def column_prompts(self, pairs: Sequence[dict]) -> list[str]:
        out = []
        for p in pairs:
            sides = {s: {k: p.get(f"{s}_{k}") for k in ("dataset", "column", "description", "data_type")} | {"examples": list(p.get(f"{s}_example_values") if p.get(f"{s}_example_values") is not None else [])} for s in ("master", "enrichment")}
            out.append(f'Do these two columns hold the same thing? Reply with a JSON object: {{"decision": "Yes" or "No", "justification": one line}}.\n{json.dumps(sides, ensure_ascii=False, default=str)}')
        return out

    def column_answers(self, pairs: Sequence[dict], replies: Sequence[str]) -> list[tuple[str, str]]:
        found = [parse_judgement(r) for r in replies]
        return [("Yes" if decision == "Yes" else "No", reason) for decision, reason in found]

    def judge_columns(self, pairs: Sequence[dict]) -> list[tuple[str, str]]:
        return self.column_answers(pairs, self.ask_each(self.column_prompts(pairs)))

    def translate_prompts(self, values: Sequence[str]) -> list[str]:
        return [f"Translate this value into English. Reply with the translation alone.\n{v}" for v in values]

    def translate_answers(self, values: Sequence[str], replies: Sequence[str]) -> list[str]:
        return [strip_fence(r).strip() or v for v, r in zip(values, replies, strict=True)]

    def translate(self, values: Sequence[str]) -> list[str]:
        return self.translate_answers(values, self.ask_each(self.translate_prompts(values)))

    def row_prompts(self, pairs: Sequence[tuple[str, str]]) -> list[str]:
        ask = 'Do these two records name the same entity? Reply with a JSON object: {{"decision": "Yes", "No" or "Maybe", "justification": one line}}.\nA: {}\nB: {}'
        return [ask.format(a, b) for a, b in pairs]

    def judge_rows(self, pairs: Sequence[tuple[str, str]]) -> list[tuple[str, str]]:
        return [parse_judgement(r) for r in self.ask_each(self.row_prompts(pairs))]

    def choose_transform(self, enrichment: Sequence[str], master: Sequence[str], hits: dict[str, int]) -> str:
        prompt = f"Which transform makes values of the first list look like those of the second? Reply with one name of: {', '.join(hits)}.\n{json.dumps([list(enrichment), list(master)], ensure_ascii=False)}"
        words = re.findall(r"[a-z0-9_]+", strip_fence(self.ask(prompt)).lower())
        return next((w for w in words if w in hits), "identity")


@dataclass(frozen=True)
class OfflineModel:
    """Rules in place of a model: templates, similar names and values, a dictionary, similar evidence, and the transform with most hits."""

    dictionary: dict[str, str] = field(default_factory=dict)
    yes: float = 80.0
    maybe: float = 60.0

    def describe(self, columns: Sequence[dict]) -> list[str]:
        return [f"{c['column_name']}: {c['data_type']}, e.g. {', '.join(c['example_values'] or []) or 'no values'}" for c in columns]

    def judge_columns(self, pairs: Sequence[dict]) -> list[tuple[str, str]]:
        out = []
        for p in pairs:
            name = token_set_ratio(*(re.sub(r"[^a-z0-9]+", " ", p[k].lower()) for k in ("master_column", "enrichment_column")))
            good = name >= self.yes or (p.get("overlap_jaccard") or 0.0) >= 0.25
            out.append(("Yes" if good else "No", f"names {name:.0f}, shared values {p.get('overlap_jaccard') or 0.0:.2f}"))
        return out

    def translate(self, values: Sequence[str]) -> list[str]:
        return [self.dictionary.get(v, v) for v in values]

    def judge_rows(self, pairs: Sequence[tuple[str, str]]) -> list[tuple[str, str]]:
        out = []
        for a, b in pairs:
            score = token_set_ratio(a.lower(), b.lower())
            out.append(("Yes" if score >= self.yes else "Maybe" if score >= self.maybe else "No", f"evidence {score:.0f}"))
        return out

    def choose_transform(self, enrichment: Sequence[str], master: Sequence[str], hits: dict[str, int]) -> str:
        return max(hits, key=lambda name: (hits[name], -list(hits).index(name)))


def connect(settings: ModelSettings, complete: Callable[[str, ModelSettings], str] | None = None, dictionary: dict[str, str] | None = None, store: str | None = None) -> LanguageModel:
    """The client of a run: a model behind ``complete``, called with these settings and its replies kept in ``store`` if one is named, or the offline rules."""
    return PromptModel(complete, settings, store=store) if complete else OfflineModel(dictionary or {})


@dataclass(frozen=True)
class CharacterCounts:
    """Vectors of how often each character of ``characters`` comes in a text: plain enough to check by hand. Texts without any have no vector."""

    characters: str = "abcdefghijklmnopqrstuvwxyz0123456789"

    @property
    def width(self) -> int:
        return len(self.characters)

    def embed(self, texts: Sequence[str]) -> list[list[float] | None]:
        found = [[float(x.count(c)) for c in self.characters] for x in (t or "" for t in texts)]
        return [v if any(v) else None for v in found]


@dataclass(frozen=True)
class HashedNgrams:
    """Vectors of hashed character trigrams, of length 1; empty texts have no vector."""

    width: int = 1024

    def embed(self, texts: Sequence[str]) -> list[list[float] | None]:
        out = []
        for text in texts:
            if not text:
                out.append(None)
                continue
            counts: dict[int, float] = {}
            padded = f" {text.lower()} "
            for i in range(max(1, len(padded) - 2)):
                h = int.from_bytes(hashlib.blake2b(padded[i : i + 3].encode(), digest_size=8).digest(), "little")
                counts[h % self.width] = counts.get(h % self.width, 0.0) + (1.0 if h >> 63 else -1.0)
            norm = math.sqrt(sum(v * v for v in counts.values()))
            vector = [0.0] * self.width
            for k, v in counts.items():
                vector[k] = v / norm if norm else 0.0
            out.append(vector if norm else None)
        return out
