"""The rules in plain Python, for comparison with the Spark expressions on small inputs."""

from __future__ import annotations

import ast
import random

PIECES = [
    "<python>", "</python>", "<PYTHON>", "</Python>", "<info>", "</info>", "<INFO>", "</iNFO>",
    "<ınfo>", "</İNFO>", "```python", "```PYTHON", "```html", "```", "```\n", "\n", " ",
    "\t", "\x0b", "\x1c", "\x85", "\xa0", " ", "　", "​", "word", "zwei", "été",
    "\U0001f600", "<p>", "<a href='x'>", "< b >", "<", ">", "x = 1\n", "x = (", "pass", "python",
    "html", "one two three four five six seven eight nine ten",
]


def random_texts(count: int, seed: int = 7) -> list[str]:
    generator = random.Random(seed)
    return ["".join(generator.choices(PIECES, k=generator.randint(0, 14))) for _ in range(count)]


FOLDED = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)} | {"\u0130": "i", "\u0131": "i"})


def fold(text: str) -> str:
    """Letter case removed, one character for one."""
    return text.translate(FOLDED)


def between_tags(text: str, tag: str) -> list[str]:
    folded, found, at = fold(text), [], 0
    while (start := folded.find(f"<{tag}>", at)) >= 0:
        body = start + len(tag) + 2
        end = folded.find(f"</{tag}>", body)
        if end < 0:
            break
        found.append(text[body:end])
        at = end + len(tag) + 3
    return found


def between_fences(text: str, language: str) -> list[str]:
    folded, found, at = fold(text), [], 0
    while (start := folded.find("```" + language, at)) >= 0:
        body = start + 3 + len(language) + 1
        if not text[body - 1 : body].isspace():
            at = start + 1
            continue
        end = text.find("```", body)
        if end < 0:
            break
        found.append(text[body:end])
        at = end + 3
    return found


def python_fences(text: str) -> list[str]:
    return between_fences(text, "python")


def html_fences(text: str) -> list[str]:
    return between_fences(text, "html")


def code_tags(text: str) -> list[str]:
    return between_tags(text, "python")


def info_tags(text: str) -> list[str]:
    return between_tags(text, "info")


def opens_tag(text: str) -> bool:
    return any(
        mark == "<" and letter.isascii() and letter.isalpha() and ">" in text[i + 2 :]
        for i, (mark, letter) in enumerate(zip(text, text[1:]))
    )


def parses(block: str) -> bool:
    try:
        ast.parse(block)
    except (SyntaxError, ValueError, RecursionError, MemoryError):
        return False
    return True


def valid_python(text: str) -> bool:
    verdicts = {parses(block) for block in python_fences(text)}
    return verdicts == {True}


def valid_html(text: str) -> bool:
    verdicts = {opens_tag(block) for block in html_fences(text)}
    return verdicts == {True}


def checks(text: str) -> tuple[bool, bool, bool]:
    infos = info_tags(text)
    tokens = len(" ".join(infos).split())
    return bool(code_tags(text)), bool(infos), bool(infos) and 10 <= tokens <= 500


def reward(text: str) -> float:
    code, info, length = checks(text)
    return float(2 * code + 2 * info + length)


def metrics(texts: list[str]) -> dict[str, float | None]:
    n = len(texts)
    blocks = [block for text in texts for block in code_tags(text)]
    found = [checks(text) for text in texts]

    def mean(values):
        values = list(values)
        return sum(values) / len(values) if values else None

    return {
        "n_samples": n,
        "format_compliance": mean(reward(t) == 3 for t in texts) or 0.0,
        "python_syntax_rate": mean(parses(b) for b in blocks) or 0.0,
        "avg_reward": mean(sum(c) for c in found),
        "avg_code_score": mean(c[0] for c in found),
        "avg_info_score": mean(c[1] for c in found),
        "avg_len_score": mean(c[2] for c in found),
    }


def without_fences(text: str) -> str:
    text = text.strip()
    for mark in ("```python", "```html", "```"):
        text = "".join(text.split(mark))
    return text


def without_first_closing_fence(text: str) -> str:
    at = text.find("```\n")
    while at >= 0 and text.startswith(("python", "html"), at + 4):
        at = text.find("```\n", at + 1)
    return text if at < 0 else text[:at] + text[at + 3 :]


VARIANTS = [
    without_fences,
    lambda text: "```js".join(text.split("```python")),
    lambda text: "```xml".join(text.split("```html")),
    without_first_closing_fence,
]
