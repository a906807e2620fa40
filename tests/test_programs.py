"""The reference workflows end to end on small files in the reference layouts."""

import os

import pytest

from orchard.plans import programs


def _write(path, lines):
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    d = tmp_path_factory.mktemp("ref")
    cats = ["arts", "business", "sports", "science"]
    head = "\t".join(["url", "id", "body", "category"] + [f"x{i}" for i in range(5)]
                     + ["label"])
    train, test = [head], [head.rsplit("\t", 1)[0]]
    for i in range(400):
        nums = [str((i * 7 + j * 3) % 13) if (i + j) % 17 else "?" for j in range(5)]
        label = 1 if (i * 7) % 13 + (i % 4) > 8 else 0
        row = [f'"http://p{i}.example"', f'"{i}"', '"{}"', f'"{cats[i % 4]}"'] + [f'"{v}"' for v in nums]
        train.append("\t".join(row + [f'"{label}"']))
        if i < 60:
            test.append("\t".join(row))
    _write(d / "pages_train.tsv", train)
    _write(d / "pages_score.tsv", test)
    _write(d / "land.csv", [",".join([str((i * 13 + j) % 50) for j in range(8)] + [str(i % 7 + 1)])
                                for i in range(300)])
    hours = [",".join(f"c{i}" for i in range(17))]
    for i in range(300):
        hr = i % 24
        hours.append(",".join(map(str, [i + 1, f"2011-01-{1 + i // 24:02d}", 1 + (i // 100) % 4, 0, 1, hr,
                                        0, (i // 24) % 7, 1, 1 + hr % 4, 0.5, 0.4, 0.6, 0.2, 3, 5,
                                        10 + hr * 3 + (i % 5)])))
    _write(d / "hourly.csv", hours)
    _write(d / "ratings.tsv", [f"{u}\t{it}\t{1 + (u * it) % 5}\t0" for u in range(1, 40) for it in range(1, 30)
                          if (u + it) % 3])
    _write(d / "titles.txt", [f"{it}|Movie {it}|1995" for it in range(1, 30)])
    return d


@pytest.mark.parametrize("model", ["naive_bayes", "logistic", "svm", "tree"])
def test_page_classifier(spark, files, model):
    out = programs.page_classifier(spark, str(files / "pages_train.tsv"), str(files / "pages_score.tsv"), model)
    ev = {r.split: r for r in out["evaluation"].collect()}
    assert set(ev) == {"validation", "test"}
    assert all(r.auc_hard is None or 0.0 <= r.auc_hard <= 1.0 for r in ev.values())
    assert sum(r.n for r in out["counts"].collect()) == 400
    preds = out["predictions"].collect()
    assert len(preds) == (20 if model == "tree" else 10)
    assert {r["class"] for r in preds} <= {"ephemeral", "evergreen"}


def test_page_classifier_tuned_nb(spark, files):
    out = programs.page_classifier(spark, str(files / "pages_train.tsv"), str(files / "pages_score.tsv"),
                                   "naive_bayes", tune_params=True)
    assert out["tuning"].count() == 5


def test_land_and_hourly_and_recommender(spark, files):
    land = programs.land_cover(spark, str(files / "land.csv"))
    assert {r.split for r in land["evaluation"].collect()} == {"validation", "test"}
    assert land["predictions"].count() <= 20
    hour = programs.hourly_rentals(spark, str(files / "hourly.csv"))
    rep = hour["predictions"].collect()
    assert len(rep) == 200 and rep[0].description.count(",") == 10
    rec = programs.recommender(spark, str(files / "ratings.tsv"), str(files / "titles.txt"))
    st = rec["stats"].first()
    assert st.n_users == 39 and st.n_items == 29
    top = rec["items_for_users"].collect()
    assert max(r.rank for r in top) == 10 and all(r.title.startswith("Movie") for r in top)


def test_page_classifier_tuned_logistic(spark, files):
    out = programs.page_classifier(spark, str(files / "pages_train.tsv"), str(files / "pages_score.tsv"),
                                   "logistic", tune_params=True)
    assert out["tuning"].count() == 36
    assert out["predictions"].count() == 10
