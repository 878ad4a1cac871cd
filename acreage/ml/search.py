"""Search over parameters: proposals from density ratios of good and bad trials, trials stopped after weak folds."""

from __future__ import annotations

import math
import random
from collections.abc import Callable
from dataclasses import dataclass, field
from statistics import mean, median

#: Trials drawn blindly at first, share and most of the trials that count as good, and draws per proposal.
STARTUP, GOOD_SHARE, GOOD_MOST, CANDIDATES = 10, 0.1, 25, 24
#: Completed trials before a running one may be stopped.
WARM = 5


@dataclass(frozen=True)
class Whole:
    """Whole numbers from low to high, by step."""

    low: int
    high: int
    step: int = 1

    def place(self, value: float) -> float:
        return (value - self.low + self.step / 2) / (self.high - self.low + self.step)

    def value(self, place: float) -> int:
        steps = (self.high - self.low) // self.step + 1
        return self.low + self.step * min(steps - 1, int(place * steps))


@dataclass(frozen=True)
class Real:
    """Numbers from low to high, evenly or by their logarithm."""

    low: float
    high: float
    log: bool = False

    def place(self, value: float) -> float:
        if self.log:
            return math.log(value / self.low) / math.log(self.high / self.low)
        return (value - self.low) / (self.high - self.low)

    def value(self, place: float) -> float:
        if self.log:
            return min(self.high, max(self.low, self.low * (self.high / self.low) ** place))
        return min(self.high, max(self.low, self.low + (self.high - self.low) * place))


Space = dict[str, Whole | Real]


@dataclass
class Trial:
    parameters: dict
    scores: list[float] = field(default_factory=list)
    stopped: bool = False

    @property
    def score(self) -> float:
        return mean(self.scores)


class Density:
    """A mixture of normals cut to [0, 1], one about each place seen and a broad one about the middle."""

    def __init__(self, places: list[float]):
        self.centres = [*sorted(places), 0.5]
        edges = [0.0, *sorted(places), 1.0]
        gaps = [max(b - a, c - b) for a, b, c in zip(edges, edges[1:], edges[2:])]
        least = 1 / min(100, len(places) + 1)
        self.widths = [*[min(1.0, max(least, g)) for g in gaps], 1.0]

    @staticmethod
    def _below(x: float, centre: float, width: float) -> float:
        return 0.5 * (1 + math.erf((x - centre) / (width * math.sqrt(2))))

    def log(self, x: float) -> float:
        total = 0.0
        for c, w in zip(self.centres, self.widths):
            inside = self._below(1, c, w) - self._below(0, c, w)
            total += math.exp(-((x - c) / w) ** 2 / 2) / (w * inside * math.sqrt(2 * math.pi))
        return math.log(max(total / len(self.centres), 1e-300))

    def draw(self, rng: random.Random) -> float:
        at = rng.randrange(len(self.centres))
        while True:  # centres lie inside, so a third of the draws at least do
            x = rng.gauss(self.centres[at], self.widths[at])
            if 0 <= x < 1:
                return x


def ranked(trials: list[Trial]) -> list[Trial]:
    """Completed trials by score, then stopped ones by the folds they reached and their score; ties by order."""
    return sorted(trials, key=lambda t: (t.stopped, -len(t.scores), -t.score))


def propose(space: Space, trials: list[Trial], rng: random.Random, startup: int = STARTUP) -> dict:
    """The next parameters: of draws from the density of the good trials' places, the one where the density of the
    others is least in comparison; each parameter by itself."""
    if len(trials) < startup:
        return {name: kind.value(rng.random()) for name, kind in space.items()}
    order = ranked(trials)
    good = min(math.ceil(GOOD_SHARE * len(order)), GOOD_MOST)
    out = {}
    for name, kind in space.items():
        places = [kind.place(t.parameters[name]) for t in order]
        near, far = Density(places[:good]), Density(places[good:])
        draws = [near.draw(rng) for _ in range(CANDIDATES)]
        out[name] = kind.value(max(draws, key=lambda x: near.log(x) - far.log(x)))
    return out


def weak(trial: Trial, others: list[Trial]) -> bool:
    """Whether the mean over the folds so far is below the median of what completed trials had after as many."""
    n = len(trial.scores)
    before = [mean(t.scores[:n]) for t in others if not t.stopped]
    return len(before) >= WARM and trial.score < median(before)


def search(
    space: Space, evaluate: Callable[[dict, int], float], trials: int, folds: int, seed: int, startup: int = STARTUP,
    stop_weak: bool = True,
) -> list[Trial]:
    """Trials in order; `evaluate` scores parameters on a fold, larger is better. With `startup` = `trials` the search is random."""
    rng, done = random.Random(seed), []
    for _ in range(trials):
        trial = Trial(propose(space, done, rng, startup))
        for fold in range(folds):
            trial.scores.append(float(evaluate(trial.parameters, fold)))
            if stop_weak and fold + 1 < folds and weak(trial, done):
                trial.stopped = True
                break
        done.append(trial)
    return done
