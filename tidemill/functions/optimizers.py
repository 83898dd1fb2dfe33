"""Update rules: pure functions on a weight vector and its slots.

SGD with momentum, Adam (Kingma & Ba 2015) and RMSprop, each with the usual
defaults of deep-learning libraries.
"""

from dataclasses import dataclass

import numpy as np

ADAM_BETA_1, ADAM_BETA_2, RMS_RHO, EPSILON = 0.9, 0.999, 0.9, 1e-7
SLOTS = {"sgd": 1, "adam": 2, "rmsprop": 1}


@dataclass(frozen=True)
class Optimizer:
    name: str = "sgd"
    lr: float = 0.01
    momentum: float = 0.0

    def slots(self, size: int) -> np.ndarray:
        return np.zeros((SLOTS[self.name], size))

    def update(self, w: np.ndarray, g: np.ndarray, slots: np.ndarray, step: int, lr: float):
        """New weights and slots; ``step`` counts from 1."""
        if self.name == "sgd":
            v = self.momentum * slots[0] - lr * g
            return w + v, np.stack([v])
        if self.name == "adam":
            m = ADAM_BETA_1 * slots[0] + (1 - ADAM_BETA_1) * g
            v = ADAM_BETA_2 * slots[1] + (1 - ADAM_BETA_2) * g * g
            rate = lr * np.sqrt(1 - ADAM_BETA_2**step) / (1 - ADAM_BETA_1**step)
            return w - rate * m / (np.sqrt(v) + EPSILON), np.stack([m, v])
        if self.name == "rmsprop":
            v = RMS_RHO * slots[0] + (1 - RMS_RHO) * g * g
            return w - lr * g / np.sqrt(v + EPSILON), np.stack([v])
        raise ValueError(f"unknown rule {self.name}")


def make_optimizer(rule) -> Optimizer:
    """Accept an Optimizer or a rule name (learning rate 0.01 for sgd, 0.001 else)."""
    if isinstance(rule, Optimizer):
        return rule
    return Optimizer(rule, 0.01 if rule == "sgd" else 0.001)
