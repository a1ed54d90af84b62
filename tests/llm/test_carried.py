"""Broadcast values on workers that have no copy of the package."""

import os
import pickle
import subprocess
import sys

import numpy as np

from corpusloom.llm import decontaminate, html_text, language, pieces, topk

def without_package(tmp_path, value, code):
    stored = tmp_path / "value"
    stored.write_bytes(pickle.dumps(value))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    code = f"import pickle, sys; value = pickle.load(open(sys.argv[1], 'rb')); assert 'corpusloom' not in sys.modules; {code}"
    done = subprocess.run([sys.executable, "-c", code, str(stored)], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert not done.returncode, done.stderr
    return done.stdout.strip()


def test_classes_travel(tmp_path):
    tests = decontaminate.TestSet([("i", "a b c d e f g h i j k"), (None, "short one")])
    assert without_package(tmp_path, tests, "print(value.scan(['x A b c d e f g h i j k', 'short one', '']))") == str(
        [(12, [1, 2], [10, 10], {"i"}), (2, [0], [2], {None}), (0, [], [], set())]
    )
    trees = language.build_trees(["x", "y"], np.array([0, 1]), np.array([97, 98], np.uint64), np.array([2, 3]))
    assert without_package(tmp_path, trees, "print(value.langs, len(value.cost))") == f"['x', 'y'] {language.ORDER + 1}"
    borders = topk.Borders([[i, -i] for i in range(100)], -99, 99)
    assert without_package(tmp_path, borders, "import numpy; print(value.cells(numpy.array([[0, 0], [99, -99]])).tolist())") == str(borders.cells(np.array([[0, 0], [99, -99]])).tolist())
    field = html_text.fit([])
    assert without_package(tmp_path, field, "print(value.decode([]))") == "[]"
    vocabulary = pieces.make({"a": -1.0}, {"a": 256}, [bytes([i]) for i in range(256)] + [b"a"], list(range(256)))
    assert without_package(tmp_path, vocabulary, "print(value.ids, value.longest)") == "{'a': 256} 1"


def test_a_copy_is_equal(tmp_path):
    tests = decontaminate.TestSet([("i", "a b"), ("j", "a b")])
    again = pickle.loads(pickle.dumps(tests))
    assert again.scan(["a b"]) == tests.scan(["a b"]) == [(2, [0], [2], {"i", "j"})]
