import pytest

from registrum.operators import gold as G
from registrum.operators.joins import fits_broadcast, measured_bytes
from registrum.plans.gold import build_gold, read_gold
from registrum.sources.parquet import MissingInput
from registrum.sources.store import SnapshotStore
from registrum.spec import KPI_BUSINESS_SIZE, KPI_BY_DEPARTMENT, KPI_DOMINANT_SECTORS, MASTER_TABLE


def _silver(spark, scratch):
    """Two departments, a sector tie, a unit without size and an establishment without unit."""
    etab = spark.createDataFrame(
        [("30120045600017", "301200456", "77", "47"), ("30120045600025", "301200456", "77", "10"), ("41255500100026", "412555001", "93", "62"), ("50000000100018", "500000001", "77", "10"), ("69999999900011", "699999999", "77", "47")],
        "siret string, siren string, departement string, secteur_activite string",
    )
    ul = spark.createDataFrame(
        [("301200456", "Pont SARL", None, None, "PME", "5499", "N"), ("412555001", None, "Durand", "Lou", "ETI", "1000", "O"), ("500000001", "Sans Taille", None, None, None, "5710", "N")],
        "siren string, denominationUniteLegale string, nomUniteLegale string, prenom1UniteLegale string, "
        "categorieEntreprise string, categorieJuridiqueUniteLegale string, economieSocialeSolidaireUniteLegale string",
    )
    SnapshotStore(spark, f"{scratch}/silver/etablissements").publish(etab)
    SnapshotStore(spark, f"{scratch}/silver/unites_legales").publish(ul)


def test_master_and_indicators(spark, scratch):
    _silver(spark, scratch)
    res = build_gold(spark, f"{scratch}/silver", f"{scratch}/gold")
    gold = f"{scratch}/gold"
    master = read_gold(spark, gold, MASTER_TABLE)
    assert res.master_rows == master.count() == 5
    assert master.columns[:4] == ["siret", "siren", "departement", "secteur_activite"]
    # written in order, most first
    assert [tuple(r) for r in read_gold(spark, gold, KPI_BY_DEPARTMENT).collect()] == [("77", 4), ("93", 1)]
    sizes = {r.categorieEntreprise: r.total for r in read_gold(spark, gold, KPI_BUSINESS_SIZE).collect()}
    assert sizes == {"PME": 2, "ETI": 1}
    sectors = {r.departement: (r.secteur_activite, r["count"]) for r in read_gold(spark, gold, KPI_DOMINANT_SECTORS).collect()}
    assert sectors == {"77": ("10", 2), "93": ("62", 1)}
    assert G.unmatched_count(master).first().unmatched == 1


def test_gold_requires_silver(spark, scratch):
    with pytest.raises(MissingInput):
        build_gold(spark, f"{scratch}/silver", f"{scratch}/gold")


def test_dominant_sector_tie_goes_to_first_name(spark):
    m = spark.createDataFrame([("75", "B"), ("75", "A"), ("75", "C"), ("75", "C")], "departement string, secteur_activite string")
    m2 = spark.createDataFrame([("75", "B"), ("75", "A")], "departement string, secteur_activite string")
    assert [tuple(r) for r in G.kpi_dominant_sector(m).collect()] == [("75", "C", 2)]
    assert [tuple(r) for r in G.kpi_dominant_sector(m2).collect()] == [("75", "A", 1)]


def test_unmatched_establishment_kept_and_counted(spark):
    etab = spark.createDataFrame([("1", "111", "75"), ("2", "999", "75")], "siret string, siren string, departement string")
    ul = spark.createDataFrame(
        [("111", "X", None, None, "PME", 1.0, "N")],
        "siren string, denominationUniteLegale string, nomUniteLegale string, prenom1UniteLegale string, "
        "categorieEntreprise string, categorieJuridiqueUniteLegale double, economieSocialeSolidaireUniteLegale string",
    )
    m = G.master_table(etab, ul, max_broadcast_bytes=None)
    assert m.count() == 2
    assert G.unmatched_count(m).first().unmatched == 1
    assert {r.categorieEntreprise: r.total for r in G.kpi_company_size(m).collect()} == {"PME": 1}


def test_broadcast_only_when_measured_small(spark):
    ul = spark.createDataFrame([("1", "abc")], "siren string, denominationUniteLegale string")
    assert measured_bytes(ul) == 2 * 8 + 4
    assert fits_broadcast(ul, 1 << 20)
    assert not fits_broadcast(ul, 10)
    etab = spark.createDataFrame([("1", "1")], "siret string, siren string")
    from registrum.operators.joins import left_join_checked

    plan = left_join_checked(etab, ul, "siren", 1 << 20)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_hot_siren_split_matches_plain_join(spark):
    import contextlib
    import io

    from pyspark.sql import functions as F

    from registrum.operators.joins import hot_keys, left_join_skew_split

    etab = spark.range(3000).select(
        F.col("id").cast("string").alias("siret"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise((F.col("id") % 500).cast("string")).alias("siren"),
    )
    ul = spark.createDataFrame([("HOT", "BigCorp")] + [(str(i), f"U{i}") for i in range(0, 500, 2)], "siren string, name string")
    assert [r.siren for r in hot_keys(etab, "siren", 0.01).collect()] == ["HOT"]
    split = left_join_skew_split(etab, ul, "siren", 0.01)
    plain = etab.join(ul, "siren", "left").select("siret", "siren", "name")
    assert sorted(map(tuple, split.select("siret", "siren", "name").collect())) == sorted(map(tuple, plain.collect()))
    assert split.filter("siren = 'HOT'").filter("name = 'BigCorp'").count() == 1000
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        split.explain()
    assert "BroadcastHashJoin" in buf.getvalue() and "SortMergeJoin" in buf.getvalue()
    m = G.master_table(
        etab.withColumn("departement", F.lit("75")),
        spark.createDataFrame([("HOT", "X", None, None, "GE", 1.0, "N")],
            "siren string, denominationUniteLegale string, nomUniteLegale string, prenom1UniteLegale string, "
            "categorieEntreprise string, categorieJuridiqueUniteLegale double, economieSocialeSolidaireUniteLegale string"),
        max_broadcast_bytes=10, split_hot_keys=True,
    )
    assert m.columns[:3] == ["siret", "siren", "departement"] and m.count() == 3000
    assert {r.categorieEntreprise: r.total for r in G.kpi_company_size(m).collect()} == {"GE": 1000}


def test_gold_skips_rebuild_when_silver_unchanged(spark, scratch):
    _silver(spark, scratch)
    first = build_gold(spark, f"{scratch}/silver", f"{scratch}/gold")
    again = build_gold(spark, f"{scratch}/silver", f"{scratch}/gold")
    assert again.version == first.version
    forced = build_gold(spark, f"{scratch}/silver", f"{scratch}/gold", force=True)
    assert forced.version == first.version + 1 and forced.master_rows == 5


def _etab_rows(spark, rows):
    return spark.createDataFrame(rows, "siret string, siren string, departement string, secteur_activite string")


def _ul_rows(spark, rows):
    return spark.createDataFrame(
        [(s, f"N{s}", None, None, size, 1.0, "N") for s, size in rows],
        "siren string, denominationUniteLegale string, nomUniteLegale string, prenom1UniteLegale string, "
        "categorieEntreprise string, categorieJuridiqueUniteLegale double, economieSocialeSolidaireUniteLegale string",
    )


def _snapshot(spark, gold):
    out = {}
    for name in (MASTER_TABLE, KPI_BY_DEPARTMENT, KPI_DOMINANT_SECTORS, KPI_BUSINESS_SIZE):
        out[name] = sorted(map(tuple, read_gold(spark, gold, name).collect()), key=str)
    return out


def test_incremental_gold_equals_full_rebuild(spark, scratch):
    silver = f"{scratch}/silver"
    es = SnapshotStore(spark, f"{silver}/etablissements")
    us = SnapshotStore(spark, f"{silver}/unites_legales")
    es.publish(_etab_rows(spark, [("1", "A", "75", "IT"), ("2", "B", "92", "IT")]))
    us.publish(_ul_rows(spark, [("A", "PME")]))
    assert build_gold(spark, silver, f"{scratch}/g1").mode == "replace"
    # new establishments only: appended segment
    es.publish(_etab_rows(spark, [("3", "A", "75", "Food"), ("4", "C", "75", "Food")]), mode="append")
    r = build_gold(spark, silver, f"{scratch}/g1")
    assert r.mode == "append" and r.master_rows == 4
    # a new legal unit that no master row uses: still incremental
    us.publish(_ul_rows(spark, [("Z", "GE")]), mode="append")
    es.publish(_etab_rows(spark, [("5", "Z", "93", "Food")]), mode="append")
    assert build_gold(spark, silver, f"{scratch}/g1").mode == "append"
    build_gold(spark, silver, f"{scratch}/g2", force=True)
    assert _snapshot(spark, f"{scratch}/g1") == _snapshot(spark, f"{scratch}/g2")
    # a new legal unit for an existing unmatched siren (B) rewrites the buckets that hold it
    us.publish(_ul_rows(spark, [("B", "ETI")]), mode="append")
    assert build_gold(spark, silver, f"{scratch}/g1").mode == "update"
    build_gold(spark, silver, f"{scratch}/g3", force=True)
    g1 = _snapshot(spark, f"{scratch}/g1")
    assert g1 == _snapshot(spark, f"{scratch}/g3")
    assert dict((k, v) for k, v in g1[KPI_BUSINESS_SIZE]) == {"PME": 2, "GE": 1, "ETI": 1}
    assert build_gold(spark, silver, f"{scratch}/g1").mode == "unchanged"


def test_lost_kpi_commit_is_finished_by_the_next_run(spark, scratch, monkeypatch):
    import registrum.plans.gold as gold_plan

    silver = f"{scratch}/silver"
    es = SnapshotStore(spark, f"{silver}/etablissements")
    us = SnapshotStore(spark, f"{silver}/unites_legales")
    es.publish(_etab_rows(spark, [("1", "A", "75", "IT")]))
    us.publish(_ul_rows(spark, [("A", "PME")]))
    build_gold(spark, silver, f"{scratch}/g")
    es.publish(_etab_rows(spark, [("2", "A", "92", "IT")]), mode="append")

    def crash(*a, **k):
        raise RuntimeError("executor lost after the master commit")

    real = gold_plan._publish_kpis
    monkeypatch.setattr(gold_plan, "_publish_kpis", crash)
    with pytest.raises(RuntimeError):
        build_gold(spark, silver, f"{scratch}/g")
    monkeypatch.setattr(gold_plan, "_publish_kpis", real)
    assert build_gold(spark, silver, f"{scratch}/g").mode == "resumed"
    build_gold(spark, silver, f"{scratch}/full", force=True)
    assert _snapshot(spark, f"{scratch}/g") == _snapshot(spark, f"{scratch}/full")
    # and the next increment builds on consistent counts
    es.publish(_etab_rows(spark, [("3", "A", "93", "Food")]), mode="append")
    assert build_gold(spark, silver, f"{scratch}/g").mode == "append"
    build_gold(spark, silver, f"{scratch}/full", force=True)
    assert _snapshot(spark, f"{scratch}/g") == _snapshot(spark, f"{scratch}/full")


FACTS = ("departement", "secteur_activite")


def _silver_stores(spark, silver, buckets):
    from registrum.sources.store import Layout

    return {n: (SnapshotStore(spark, f"{silver}/{n}"), Layout(k, buckets)) for n, k in (("etablissements", "siret"), ("unites_legales", "siren"))}


def _deliver(spark, store, layout, df, ts, again=()):
    """As the Silver job publishes: new keys appended, buckets of repeated ones rewritten; the mark in the marker."""
    from datetime import datetime

    from pyspark.sql import functions as F

    from registrum.functions.columns import ntz

    snap, rows = store.current(), df.withColumn("ingested_at", ntz(datetime(2026, 1, ts)))
    touched = {r[0] for r in rows.filter(F.col(layout.key).isin(list(again))).select(layout.bucket()).distinct().collect()}
    if touched:
        old = store.rows_of(snap, buckets=touched)
        rows = old.filter(~F.col(layout.key).isin(list(again))).unionByName(rows)
    store.publish(rows, mode="append", layout=layout, replaces=touched, fan_in=3, facts={"mark": f"2026-01-{ts:02d}T00:00:00"})


def test_random_inserts_updates_and_late_units_equal_a_forced_rebuild(spark, scratch):
    import random

    rng = random.Random(8)
    silver, gold = f"{scratch}/silver", f"{scratch}/gold"
    stores = _silver_stores(spark, silver, 4)
    etab, ul, modes = {}, {}, []
    for day in range(1, 9):
        for name, (store, layout) in stores.items():
            known = etab if name == "etablissements" else ul
            again = rng.sample(sorted(known), min(len(known), rng.choice([0, 1, 3]))) if day > 1 else []
            if name == "etablissements":
                fresh = [f"e{day}-{i}" for i in range(rng.choice([0, 3, 8]) if day > 1 else 20)]
                rows = [(k, known[k] if k in known else f"s{rng.randrange(12)}", rng.choice(["75", "92"]), rng.choice(["IT", "Food"])) for k in [*again, *fresh]]
                known.update({k: siren for k, siren, *_ in rows})
                df = _etab_rows(spark, rows or [("x", "x", "x", "x")])
            else:
                fresh = [k for k in (f"s{i}" for i in rng.sample(range(12), 3)) if k not in known]
                rows = [(k, rng.choice(["PME", "ETI", "GE", None])) for k in [*again, *fresh]]
                known.update(dict(rows))
                df = _ul_rows(spark, rows or [("x", "x")])
            if rows:
                _deliver(spark, store, layout, df, day, again)
        modes.append(build_gold(spark, silver, gold, buckets=8).mode)
        build_gold(spark, silver, f"{scratch}/full", force=True)
        assert _snapshot(spark, gold) == _snapshot(spark, f"{scratch}/full"), modes
    assert modes[0] == "replace" and "update" in modes and modes.count("replace") == 1


def test_only_buckets_of_a_late_unit_are_rewritten(spark, scratch):
    silver, gold = f"{scratch}/silver", f"{scratch}/gold"
    stores = _silver_stores(spark, silver, 4)
    _deliver(spark, *stores["etablissements"], _etab_rows(spark, [(f"e{i}", f"s{i % 40}", "75", "IT") for i in range(200)]), 1)
    _deliver(spark, *stores["unites_legales"], _ul_rows(spark, [(f"s{i}", "PME") for i in range(39)]), 1)
    build_gold(spark, silver, gold, buckets=16)
    master = SnapshotStore(spark, f"{gold}/{MASTER_TABLE}")
    before = master.current()
    _deliver(spark, *stores["unites_legales"], _ul_rows(spark, [("s39", "GE")]), 2)
    assert build_gold(spark, silver, gold).mode == "update"
    after = master.current()
    assert len(before.paths) > 8 and len(set(before.paths) - set(after.paths)) == 1 and len(set(after.paths) - set(before.paths)) == 1
    assert after.segments[-1].rows < 60
    sizes = {r.categorieEntreprise: r.total for r in read_gold(spark, gold, KPI_BUSINESS_SIZE).collect()}
    assert sizes == {"PME": 195, "GE": 5}
    # a changed establishment: the bucket of its siren alone
    _deliver(spark, *stores["etablissements"], _etab_rows(spark, [("e7", "s7", "93", "Food")]), 3, ["e7"])
    assert build_gold(spark, silver, gold).mode == "update"
    assert len(set(after.paths) - set(master.current().paths)) == 1
    assert {r.departement: r.total_establishments for r in read_gold(spark, gold, KPI_BY_DEPARTMENT).collect()} == {"75": 199, "93": 1}


def test_silver_made_anew_is_not_taken_for_the_old_one(spark, scratch):
    import os

    silver, gold = f"{scratch}/silver", f"{scratch}/gold"
    for n in range(2):
        stores = _silver_stores(spark, silver, 2)
        _deliver(spark, *stores["etablissements"], _etab_rows(spark, [(f"{n}", f"s{n}", "75", "IT")]), 1)
        _deliver(spark, *stores["unites_legales"], _ul_rows(spark, [(f"s{n}", "PME")]), 1)
        assert build_gold(spark, silver, gold).mode == "replace"
        os.rename(silver, f"{scratch}/old{n}")
