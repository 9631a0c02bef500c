"""Skip-chain conditional random fields: potentials from counts, labels by message passing.

A field has nodes with one label each, and edges of several kinds: chain edges between
neighbours, and skip edges between distant nodes that are alike. Potentials are trained
piecewise, each kind of edge by itself, from counts of labels; marginals come from loopy
sum-product messages.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

# Rounds of messages at most, the share of an old message that stays, and the change at which
# messages count as settled.
ROUNDS, DAMPING, SETTLED = 40, 0.5, 1e-4
# Weight of the prior in counts of a feature and of a kind of edge, in observations.
FEATURE_PRIOR, EDGE_PRIOR = 1.0, 10.0
# Edges say this much at most, in nats.
STRONGEST = 8.0
# Log weight of labels that an observed node does not have.
NEVER = -40.0


@dataclass(frozen=True)
class Potentials:
    """Log potentials: ``nodes`` of each feature and label, ``groups`` of each group of features,
    ``prior`` for groups never seen, and ``edges`` of each kind and pair of labels. A feature is
    a pair of its group and its place in the group."""

    nodes: dict[tuple[int, int], np.ndarray]
    groups: dict[int, np.ndarray]
    prior: np.ndarray
    edges: np.ndarray

    def node(self, feature: tuple[int, int]) -> np.ndarray:
        """The potential of a node; that of its group if its feature was never seen."""
        if feature in self.nodes:
            return self.nodes[feature]
        return self.groups.get(feature[0], self.prior)


def fit_potentials(
    features: dict[tuple[int, int], np.ndarray], edges: np.ndarray, skips: Sequence[int] = ()
) -> Potentials:
    """Potentials from counts of labels by feature, and of pairs of labels by kind of edge.

    A node's potential is the log probability of its label given its feature, smoothed by that
    given the group of the feature, and this by that of all nodes; an edge's the smoothed log ratio of how often two labels meet to how often they would by
    chance. The kinds in ``skips`` share one potential for all labels: the log odds of
    agreement, against those by chance. Kinds of edges without counts say nothing.
    """
    labels = edges.shape[-1]
    total = sum(features.values(), np.zeros(labels)) + 1.0 / labels
    prior = total / total.sum()

    def smoothed(n: np.ndarray, by: np.ndarray) -> np.ndarray:
        return (n + FEATURE_PRIOR * by) / (n.sum() + FEATURE_PRIOR)

    totals: dict[int, np.ndarray] = {}
    for (group, _), n in features.items():
        totals[group] = totals.get(group, 0) + n
    groups = {group: smoothed(n, prior) for group, n in totals.items()}
    nodes = {f: np.log(smoothed(n, groups[f[0]])) for f, n in features.items()}
    pair = np.zeros(edges.shape)
    for kind, n in enumerate(edges.astype(float)):
        if n.sum():
            seen = n + 1e-3
            chance = np.outer(seen.sum(1), seen.sum(0)) / seen.sum() ** 2
            if kind in skips:
                counts = np.array([np.trace(n), n.sum() - np.trace(n)])
                agree = min(np.trace(chance), 1 - 1e-9)
                chance = np.array([agree, 1 - agree])
                ratio = (counts + EDGE_PRIOR * chance) / chance
                pair[kind] = np.eye(labels) * np.clip(np.log(ratio[0] / ratio[1]), 0, STRONGEST)
            else:
                ratio = (n + EDGE_PRIOR * chance) / (n.sum() + EDGE_PRIOR) / chance
                pair[kind] = np.clip(np.log(ratio), -STRONGEST, STRONGEST)
    return Potentials(nodes, {g: np.log(x) for g, x in groups.items()}, np.log(prior), pair)


def _normal(x: np.ndarray) -> np.ndarray:
    x = x - x.max(-1, keepdims=True)
    return x - np.log(np.exp(x).sum(-1, keepdims=True))


def marginals(unary: np.ndarray, edges: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """Probability of every label of every node.

    ``unary`` has log weights of shape (nodes, labels); ``edges`` has rows (from, to, kind);
    ``pair`` log weights of shape (kinds, labels, labels). Exact on trees; on loops the fixed
    point of damped messages, or where they stand after a bounded number of rounds. Fields that
    do not touch may be given together. Time and memory are linear in nodes and edges.
    """
    n, labels = unary.shape
    if not len(edges):
        return np.exp(_normal(unary))
    source = np.concatenate([edges[:, 0], edges[:, 1]])
    target = np.concatenate([edges[:, 1], edges[:, 0]])
    weight = np.concatenate([pair[edges[:, 2]], pair[edges[:, 2]].transpose(0, 2, 1)])
    back = np.roll(np.arange(len(source)), len(edges))
    messages = np.zeros((len(source), labels))

    def gathered() -> np.ndarray:
        total = unary.copy()
        np.add.at(total, target, messages)
        return total

    for _ in range(ROUNDS):
        inside = gathered()[source] - messages[back]
        sums = inside[:, :, None] + weight
        top = sums.max(1)
        new = _normal(top + np.log(np.exp(sums - top[:, None]).sum(1)))
        change = np.abs(np.exp(new) - np.exp(_normal(messages))).max()
        messages = new if change < SETTLED else DAMPING * messages + (1 - DAMPING) * new
        if change < SETTLED:
            break
    return np.exp(_normal(gathered()))
