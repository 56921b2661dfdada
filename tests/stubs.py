"""A flaky chat service for tests: rule answers in several layouts, errors by key."""

from __future__ import annotations


class RuleStub:
    """Deterministic offline predictor.

    Labels come from the prompt length; the answer layout cycles with the row id through
    seven shapes (clean, wrapped in prose, no JSON, unclosed, string value, two objects,
    boolean + extra key). Some ids fail once (retried), some always fail.
    """

    def __init__(self, keys=("quality", "toxic"), long_prompt: int = 2000, fail_once_mod: int = 11,
                 always_fail_mod: int = 13):
        self.keys = list(keys)
        self.long_prompt = long_prompt
        self.fail_once_mod = fail_once_mod
        self.always_fail_mod = always_fail_mod
        self._seen: set = set()

    def labels(self, prompt: str):
        n = len(prompt)
        first = [1 if n >= self.long_prompt else 0, 1 if n % 3 == 0 else 0]
        more = [1 if (n + i) % 2 == 0 else 0 for i in range(2, len(self.keys))]
        return (first + more)[:len(self.keys)]

    def answer(self, key, prompt):
        key = int(key)
        if self.always_fail_mod and key % self.always_fail_mod == 0:
            raise RuntimeError("service unavailable")
        if self.fail_once_mod and key % self.fail_once_mod == 0 and key not in self._seen:
            self._seen.add(key)
            raise RuntimeError("rate limited")
        return answer_text(key, self.keys, self.labels(prompt))


def answer_text(key: int, keys, values) -> str:
    """The stub's answer in one of seven layouts, chosen by ``key % 7``."""
    pairs = [f'"{k}": {v}' for k, v in zip(keys, values)]
    shape = key % 7
    if shape == 0:
        return "I am not able to tell from this essay."
    if shape == 1:
        return "Result: {" + ", ".join(pairs)
    if shape == 2:
        return "Sure!\n{" + ",\n ".join(pairs) + "} ok"
    if shape == 3:
        return "{" + ", ".join(pairs) + "}"
    if shape == 4:
        return "{" + ", ".join([f'"{keys[0]}": "{values[0]}"'] + pairs[1:]) + "}"
    if shape == 5:
        return "{" + pairs[0] + "} and {" + ", ".join(pairs[1:]) + "}"
    first = f'"{keys[0]}": ' + ("true" if values[0] else "false")
    return "  {" + ", ".join([first] + pairs[1:] + ['"note": "x"']) + "}  "


class Counted:
    """Answers lengths; writes a line per question; dies once at question 17."""

    def __init__(self, folder):
        self.folder = folder

    def answer_batch(self, keys, inputs):
        import os
        if 17 in list(keys) and not os.path.exists(f"{self.folder}/died"):
            open(f"{self.folder}/died", "w").close()
            os._exit(1)
        with open(f"{self.folder}/asked", "a") as f:
            f.write("".join(f"{k}\n" for k in keys))
        return [str(len(p)) for p in inputs]
