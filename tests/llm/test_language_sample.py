"""Language ID trains in tasks: the driver gets models and scores, never the sample."""

import random
import zlib

import numpy as np
import pytest
from odd_texts import SYLLABLES, prose

from logtide.llm import language_id


@pytest.fixture(scope="module")
def labelled(spark):
    rnd = random.Random(11)
    rows = [(i, prose(rnd, lang, 40), lang) for i, lang in enumerate(sorted(SYLLABLES) * 30)]
    rows += [rows[0], (None, rows[1][1], "en"), (-7, "null id and negative id", "en"), (500, None, "de"), (501, "", "de"), (502, "no language", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_the_driver_never_gets_the_sample(labelled, monkeypatch):
    got, collect = [], type(labelled).collect

    def noted(self):
        got.append(collect(self))
        return got[-1]

    monkeypatch.setattr(type(labelled), "collect", noted)
    language_id.identify(labelled, labelled)
    assert got and max(map(len, got)) <= max(len(SYLLABLES), language_id.FOLDS)


def test_folds_fitted_in_tasks_make_the_model_of_one_process(labelled):
    sample = language_id.labelled_sample(labelled, 1500, "doc_id", "text", "lang")
    model, again = language_id.train(sample), language_id.train(sample.repartition(7, "subwords"))

    rows = [r for r in sample.collect()]
    assert len(rows) == 30 * len(SYLLABLES) + 3
    rows.sort(key=lambda r: ((r.id or 0) * 2654435761 % (1 << 32), r.id or 0, r.lang, len(r.subwords), zlib.crc32(r.shares, zlib.crc32(r.subwords))))
    languages = sorted({r.lang for r in rows})
    fit = [(np.frombuffer(r.subwords, language_id.BUCKET), np.frombuffer(r.shares, np.float32), languages.index(r.lang)) for r in rows]
    table, bias, right = 0, 0, []
    for fold in range(language_id.FOLDS):
        part, offset = language_id._fit([r for i, r in enumerate(fit) if i % language_id.FOLDS != fold], len(languages), 7 + fold)
        table, bias = table + part / language_id.FOLDS, bias + offset / language_id.FOLDS
        for at, share, y in fit[fold::language_id.FOLDS]:
            z = (share @ part[at] + offset) / model.temperature
            p = np.exp(z - z.max())
            if z.argmax() == y:
                right.append(p.max() / p.sum())
    table[0] = 0
    for m in (model, again):
        assert m.languages == languages and m.temperature == model.temperature
        assert np.allclose(m.table, table, atol=1e-5) and np.allclose(m.bias, bias, atol=1e-6)
        assert m.reject_below == pytest.approx(sorted(right)[max(1, int(language_id.ALPHA * (len(right) + 1))) - 1], abs=1e-6)


def test_no_sample(labelled):
    model = language_id.train(language_id.labelled_sample(labelled.where("lang IS NULL"), 1500, "doc_id", "text", "lang"))
    assert model.languages == [] and model.table.shape == (1 << language_id.BITS, 0) and model.reject_below == 0
