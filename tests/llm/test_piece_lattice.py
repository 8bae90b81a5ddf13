"""The forward pass walks the pieces character by character; paths equal those of trying every segmentation."""

import random
from types import SimpleNamespace

from panelcast.llm.pieces import NEG, Lattice


class Pieces:
    """A vocabulary of plain pieces with scores, without byte pieces."""

    def __init__(self, scores):
        self.items = list(scores.items())

    def get_piece_size(self):
        return len(self.items)

    def id_to_piece(self, i):
        return self.items[i][0]

    def get_score(self, i):
        return self.items[i][1]

    def unk_id(self):
        return 99

    def is_byte(self, i):
        return False

    is_control = is_unknown = is_unused = is_byte


def every_path(unit, scores, unknown):
    if not unit:
        return [(0.0, [])]
    out = []
    for j in range(1, len(unit) + 1):
        piece = unit[:j]
        if piece in scores or j == 1:
            out += [(scores.get(piece, unknown) + s, [piece, *rest]) for s, rest in every_path(unit[j:], scores, unknown)]
    return out


def test_best_and_second_path_equal_every_segmentation():
    rng = random.Random(5)
    scores = {"a": -2.0, "ab": -2.5, "abc": -3.25, "bc": -2.75, "cab": -3.5, "b": -4.0, "abca": -9.0}  # c and d have no piece of their own
    lattice = Lattice(SimpleNamespace(processor=Pieces(scores), byte_ids=[-1] * 256))
    number = {p: i for i, p in enumerate(scores)}
    for unit in ["", "c", "d", "abcab", *("".join(rng.choice("abcd") for _ in range(rng.randrange(1, 9))) for _ in range(150))]:
        paths = sorted(every_path(unit, scores, lattice.unknown_score), key=lambda p: -p[0])
        score, ids, second = lattice.best_path(unit)
        assert score == paths[0][0]
        assert second == (paths[1][0] if len(paths) > 1 else NEG)
        assert ids in [[number.get(x, 99) for x in p] for s, p in paths if s == score]
        assert lattice.n_best(unit, 1)[0][0] == score


def test_a_walk_ends_where_no_longer_piece_follows():
    lattice = Lattice(SimpleNamespace(processor=Pieces({"a": -1.0, "ab": -2.0}), byte_ids=[-1] * 256))
    assert lattice.first["a"][2]["b"] == (-2.0, [1], None)
