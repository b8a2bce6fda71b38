import contextlib
import io
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from registrum.functions.columns import exact_digits, ntz, prefix_in
from registrum.operators.clean import batch_id_of, clean_increment, select_increment, silver_increment
from registrum.operators.merge import merge_last_wins
from registrum.operators.quality import SchemaViolation, check_columns, validate
from registrum.plans.bronze import ingest_bronze
from registrum.plans.silver import build_silver, current_mark
from registrum.sources.store import SnapshotStore
from registrum.spec import ESTABLISHMENTS, LEGAL_UNITS, MARK_FLOOR, REGION_DEPARTMENTS, spec_for

ETAB_SCHEMA = (
    "siret string, siren string, etatAdministratifEtablissement string, dateCreationEtablissement date, "
    "codePostalEtablissement string, libelleCommuneEtablissement string, activitePrincipaleEtablissement string, "
    "trancheEffectifsEtablissement string, etablissementSiege boolean, enseigne1Etablissement string"
)


def etab_row(siret, cp="75001", d=date(2000, 1, 1), naf="62.01Z", siren="123456789", **kw):
    base = dict(
        siret=siret, siren=siren, etatAdministratifEtablissement=kw.get("etat"), dateCreationEtablissement=d,
        codePostalEtablissement=cp, libelleCommuneEtablissement=kw.get("commune"),
        activitePrincipaleEtablissement=naf, trancheEffectifsEtablissement=kw.get("tranche"),
        etablissementSiege=kw.get("siege"), enseigne1Etablissement=kw.get("enseigne"),
    )
    return tuple(base.values())


def bronze_df(spark, rows, ts=datetime(2026, 1, 1)):
    return spark.createDataFrame(rows, ETAB_SCHEMA).withColumn("ingested_at", ntz(ts))


def clean(spark, rows, departments=REGION_DEPARTMENTS):
    return silver_increment(bronze_df(spark, rows), ESTABLISHMENTS, MARK_FLOOR, departments, 2026)


def test_siret_validation(sample_etablissements):
    flags = [r[0] for r in sample_etablissements.select(exact_digits(F.col("siret"), 14)).collect()]
    assert flags == [True, False, True, True]


def test_region_filtering(spark):
    df = spark.createDataFrame([("75",), ("69",), ("93",), ("13",)], "dept string")
    out = df.filter(prefix_in(F.col("dept"), REGION_DEPARTMENTS))
    assert out.count() == 2
    assert "69" not in [r.dept for r in out.collect()]


def test_region_predicate_is_pushed_to_parquet(spark, scratch):
    bronze_df(spark, [etab_row("12345678901234")]).write.parquet(f"{scratch}/b")
    inc = select_increment(spark.read.parquet(f"{scratch}/b"), ESTABLISHMENTS, MARK_FLOOR, REGION_DEPARTMENTS)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        inc.explain("formatted")
    plan = buf.getvalue()
    assert "StringStartsWith(codePostalEtablissement,75)" in plan
    assert "GreaterThan(ingested_at," in plan


def test_date_clamp_bounds(spark):
    dates = [date(1677, 12, 31), date(1678, 1, 1), date(2261, 12, 31), date(2262, 1, 1), None]
    rows = [etab_row(f"{i:014d}", d=d) for i, d in enumerate(dates)]
    got = {r.siret: r for r in clean(spark, rows).collect()}
    kept = [got[f"{i:014d}"].dateCreationEtablissement for i in range(5)]
    assert kept == [None, datetime(1678, 1, 1), datetime(2261, 12, 31), None, None]
    ages = [got[f"{i:014d}"].age_entreprise for i in range(5)]
    assert ages == [-1.0, 348.0, -235.0, -1.0, -1.0]


def test_postal_edge_cases(spark):
    cps = ["75001 ", " 75001", "7500", "75x01", None, "75 001", "75001\n"]
    rows = [etab_row(f"{i:014d}", cp=c) for i, c in enumerate(cps)]
    got = {r.siret: r.codePostalEtablissement for r in clean(spark, rows).collect()}
    # trailing space trimmed and kept; leading space fails the raw-prefix
    # region filter; short, letters, NULL and inner spaces dropped
    assert got == {"00000000000000": "75001", "00000000000006": "75001"}


def test_fills_sector_and_age(spark):
    rows = [etab_row("00000000000001", naf=None, d=None), etab_row("00000000000002", naf="47.11A", d=date(2030, 5, 1))]
    got = {r.siret: r for r in clean(spark, rows).collect()}
    a, b = got["00000000000001"], got["00000000000002"]
    assert a.secteur_activite == "Indéterminé" and a.activitePrincipaleEtablissement == "Indéterminé"
    assert a.age_entreprise == -1.0 and b.age_entreprise == -4.0
    assert a.etatAdministratifEtablissement == "A" and a.trancheEffectifsEtablissement == "00"
    assert a.enseigne1Etablissement == "Non renseigné" and a.libelleCommuneEtablissement == "Indéterminé"
    assert a.etablissementSiege is None  # booleans are never text-filled
    assert b.secteur_activite == "47" and a.departement == "75"


def test_null_keys_dropped(spark):
    rows = [etab_row(None), etab_row("00000000000001", siren=None), etab_row("00000000000002")]
    assert [r.siret for r in clean(spark, rows).collect()] == ["00000000000002"]


def test_new_row_wins_on_merge(spark):
    old = clean(spark, [etab_row("00000000000001", enseigne="old"), etab_row("00000000000002", enseigne="keep")])
    new_b = bronze_df(spark, [etab_row("00000000000001", enseigne="new")], datetime(2026, 2, 1))
    new = silver_increment(new_b, ESTABLISHMENTS, datetime(2026, 1, 1), REGION_DEPARTMENTS, 2026)
    got = {r.siret: r.enseigne1Etablissement for r in merge_last_wins(old, new, ESTABLISHMENTS).collect()}
    assert got == {"00000000000001": "new", "00000000000002": "keep"}


def test_same_timestamp_new_beats_old(spark):
    old = clean(spark, [etab_row("00000000000001", enseigne="old")])
    new = clean(spark, [etab_row("00000000000001", enseigne="new")])
    got = merge_last_wins(old, new, ESTABLISHMENTS).collect()
    assert [r.enseigne1Etablissement for r in got] == ["new"]


def test_merge_invariant_under_repartitioning(spark):
    rows = [etab_row(f"{i % 37:014d}", enseigne=f"e{i}") for i in range(300)]
    a = clean(spark, rows)
    one = sorted(map(tuple, merge_last_wins(None, a.repartition(1), ESTABLISHMENTS).collect()))
    many = sorted(map(tuple, merge_last_wins(None, a.repartition(16), ESTABLISHMENTS).collect()))
    assert one == many and len(one) == 37


def test_uniqueness_violation_blocks_publication(spark, scratch):
    rows = [etab_row("00000000000001", siren="111111111"), etab_row("00000000000001", siren="222222222")]
    b = f"{scratch}/bronze"
    ingest_bronze(spark, bronze_df(spark, rows).drop("ingested_at"), b, "unused_name", datetime(2026, 1, 1))
    with pytest.raises(SchemaViolation, match="siret:unique"):
        build_silver(spark, "etablissements", b, f"{scratch}/silver", 2026)
    assert SnapshotStore(spark, f"{scratch}/silver/etablissements").current() is None


def test_closed_column_set(spark):
    good = clean(spark, [etab_row("00000000000001")])
    check_columns(good, ESTABLISHMENTS)
    with pytest.raises(SchemaViolation, match="extra"):
        check_columns(good.withColumn("x", F.lit(1)), ESTABLISHMENTS)
    with pytest.raises(SchemaViolation, match="missing"):
        check_columns(good.drop("departement"), ESTABLISHMENTS)
    validate(good, ESTABLISHMENTS)


def test_unknown_dataset():
    with pytest.raises(ValueError):
        spec_for("nope")


def _bronze(spark, scratch, rows, ts):
    b = f"{scratch}/bronze"
    ingest_bronze(spark, spark.createDataFrame(rows, ETAB_SCHEMA), b, "etablissements", ts)
    return b


def test_incremental_runs_and_mark(spark, scratch):
    silver = f"{scratch}/silver"
    store = SnapshotStore(spark, f"{silver}/etablissements")
    assert current_mark(store) == MARK_FLOOR
    b = _bronze(spark, scratch, [etab_row("00000000000001"), etab_row("00000000000002", cp="69001")], datetime(2026, 1, 1))
    r1 = build_silver(spark, "etablissements", b, silver, 2026)
    assert (r1.new_rows, r1.total_rows, r1.version) == (1, 1, 1)
    assert current_mark(store) == datetime(2026, 1, 1)
    # nothing new: no write, no new version
    r2 = build_silver(spark, "etablissements", b, silver, 2026)
    assert (r2.new_rows, r2.version) == (0, 1)
    _bronze(spark, scratch, [etab_row("00000000000003", cp="93100")], datetime(2026, 2, 1))
    r3 = build_silver(spark, "etablissements", b, silver, 2026)
    assert (r3.new_rows, r3.total_rows, r3.version) == (1, 2, 2)
    assert current_mark(store) == datetime(2026, 2, 1)


def test_two_batches_equal_one_batch(spark, scratch):
    rows = [etab_row(f"{i:014d}", cp=f"{75 + i % 3}{i % 10}{i % 7}0") for i in range(40)]
    one = clean(spark, rows)
    first = clean(spark, rows[:20])
    second = silver_increment(
        bronze_df(spark, rows[20:], datetime(2026, 1, 1)), ESTABLISHMENTS, MARK_FLOOR, REGION_DEPARTMENTS, 2026
    )
    merged = merge_last_wins(first, second, ESTABLISHMENTS)
    got = sorted(map(tuple, merged.collect()))
    assert got == sorted(map(tuple, one.collect())) and len(got) > 20


def test_legal_units_chain(spark):
    df = spark.createDataFrame(
        [("123456789", None, None, None, None, 5710.0, None, "A", date(1990, 1, 1), None)],
        "siren string, denominationUniteLegale string, nomUniteLegale string, prenom1UniteLegale string, "
        "categorieEntreprise string, categorieJuridiqueUniteLegale double, activitePrincipaleUniteLegale string, "
        "etatAdministratifUniteLegale string, dateCreationUniteLegale date, economieSocialeSolidaireUniteLegale string",
    ).withColumn("ingested_at", ntz(datetime(2026, 1, 1)))
    out = clean_increment(df, LEGAL_UNITS, 2026)
    validate(out, LEGAL_UNITS)
    r = out.first()
    assert r.economieSocialeSolidaireUniteLegale == "N" and r.categorieEntreprise == "Indéterminé"
    assert r.secteur_activite == "Indéterminé" and r.age_entreprise == 36.0


def test_new_keys_append_a_segment_and_repeated_keys_rewrite(spark, scratch):
    silver = f"{scratch}/silver"
    store = SnapshotStore(spark, f"{silver}/etablissements")
    b = _bronze(spark, scratch, [etab_row("00000000000001", enseigne="a")], datetime(2026, 1, 1))
    build_silver(spark, "etablissements", b, silver, 2026)
    _bronze(spark, scratch, [etab_row("00000000000002", enseigne="b")], datetime(2026, 2, 1))
    build_silver(spark, "etablissements", b, silver, 2026)
    snap = store.current()
    assert len(snap.paths) == 2 and snap.facts["rows"] == 2  # appended, nothing rewritten
    # a Bronze written elsewhere (parity mode, external feed) may repeat a key:
    # the full last-wins merge runs and replaces the table with one directory
    again = bronze_df(spark, [etab_row("00000000000001", enseigne="a2")], datetime(2026, 3, 1))
    again.withColumn("batch_id", F.lit(batch_id_of(datetime(2026, 3, 1)))).write.mode("append").partitionBy("batch_id").parquet(b)
    r = build_silver(spark, "etablissements", b, silver, 2026)
    snap = store.current()
    assert len(snap.paths) == 1 and r.total_rows == 2
    got = {x.siret: x.enseigne1Etablissement for x in store.read().collect()}
    assert got == {"00000000000001": "a2", "00000000000002": "b"}
    assert current_mark(store) == datetime(2026, 3, 1)


def test_segments_are_compacted(spark, scratch):
    silver = f"{scratch}/silver"
    store = SnapshotStore(spark, f"{silver}/etablissements")
    b = f"{scratch}/bronze"
    for i in range(4):
        ingest_bronze(
            spark, spark.createDataFrame([etab_row(f"{i:014d}")], ETAB_SCHEMA), b, "etablissements", datetime(2026, 1, 1 + i)
        )
        build_silver(spark, "etablissements", b, silver, 2026, max_segments=3)
    snap = store.current()
    assert len(snap.paths) == 1 and snap.facts["rows"] == 4
    assert store.read().count() == 4
    assert current_mark(store) == datetime(2026, 1, 4)


def test_row_stamped_at_the_mark_is_not_reread(spark, scratch):
    silver = f"{scratch}/silver"
    b = _bronze(spark, scratch, [etab_row("00000000000001")], datetime(2026, 1, 1))
    build_silver(spark, "etablissements", b, silver, 2026)
    # a late row carrying exactly the mark's timestamp: the mark is strict
    late = bronze_df(spark, [etab_row("00000000000009")], datetime(2026, 1, 1))
    late.withColumn("batch_id", F.lit(batch_id_of(datetime(2026, 1, 1)))).write.mode("append").partitionBy(
        "batch_id"
    ).parquet(b)
    r = build_silver(spark, "etablissements", b, silver, 2026)
    assert r.new_rows == 0 and r.total_rows == 1


@pytest.mark.parametrize("torn", ["", "{not json", '{"rows": 1}'])
def test_torn_marker_is_ignored_and_left(spark, scratch, torn):
    """A writer that dies between creating and filling a marker costs its version, nothing else."""
    from registrum.sources import parquet as pq

    store = SnapshotStore(spark, f"{scratch}/silver/etablissements")
    store.publish(clean(spark, [etab_row("00000000000001")]), facts={"mark": "2026-02-03T00:00:00"})
    pq.write_text(spark, f"{scratch}/silver/etablissements/_commits/00000002", torn)
    assert current_mark(store).isoformat() == "2026-02-03T00:00:00"  # not reset to 1900
    assert store.read().count() == 1
    assert store.publish(clean(spark, [etab_row("00000000000002")]), mode="append").version == 3
    assert store.read().count() == 2 and store.committed() == [1, 3]
    assert not [n for n in pq.list_names(spark, f"{scratch}/silver/etablissements/_commits") if n.endswith(".tmp")]


def test_old_directories_outlive_a_grace_period(spark, scratch):
    from registrum.sources import parquet as pq

    df = spark.createDataFrame([("a",)], "k string")
    for grace, left in ((3600.0, 4), (0.0, 2)):
        store = SnapshotStore(spark, f"{scratch}/{left}", grace_seconds=grace)
        for _ in range(4):
            store.publish(df)
        assert sum(n.startswith("v=") for n in pq.list_names(spark, f"{scratch}/{left}")) == left


def test_value_that_does_not_fit_its_type_stops_the_run(spark, scratch, column="etablissementSiege", bad="maybe"):
    """Before any cast: the value is not published as NULL, and the version before stays."""
    from datetime import datetime

    from registrum.operators.quality import SchemaViolation
    from registrum.plans.bronze import ingest_bronze
    from registrum.plans.catalog import etab_stock

    from .conftest import SF001

    stock = etab_stock(spark, SF001)
    ingest_bronze(spark, stock.limit(400), f"{scratch}/bronze/a", "etablissements", datetime(2026, 1, 1))
    first = build_silver(spark, "etablissements", f"{scratch}/bronze/a", f"{scratch}/silver", 2026)
    assert first.version == 1
    text = stock.withColumn(column, F.when(F.col("siret").cast("long") % 2 == 0, F.lit(bad)).otherwise(F.col(column).cast("string")))
    ingest_bronze(spark, text, f"{scratch}/bronze/b", "etablissements", datetime(2026, 1, 2))
    with pytest.raises(SchemaViolation, match=f"{column}:coerce"):
        build_silver(spark, "etablissements", f"{scratch}/bronze/b", f"{scratch}/silver", 2026)
    store = SnapshotStore(spark, f"{scratch}/silver/etablissements")
    assert store.current().version == 1 and store.read().count() == first.total_rows


def test_fully_rejected_batch_is_not_read_again(spark, scratch):
    from registrum.plans.silver import bronze_batches

    silver = f"{scratch}/silver"
    store = SnapshotStore(spark, f"{silver}/etablissements")
    b = _bronze(spark, scratch, [etab_row("00000000000001")], datetime(2026, 1, 1))
    build_silver(spark, "etablissements", b, silver, 2026)
    # a batch with only out-of-region rows: nothing accepted, mark unchanged
    _bronze(spark, scratch, [etab_row("00000000000002", cp="69001")], datetime(2026, 2, 1))
    r = build_silver(spark, "etablissements", b, silver, 2026)
    assert r.new_rows == 0 and r.total_rows == 1
    snap = store.current()
    assert snap.facts["bronze_batch"] == bronze_batches(spark, b)[-1] == batch_id_of(datetime(2026, 2, 1))
    assert current_mark(store) == datetime(2026, 1, 1)  # the mark itself is the data's
    # later batches are still read; the rejected one is skipped
    _bronze(spark, scratch, [etab_row("00000000000003", cp="75002")], datetime(2026, 3, 1))
    r = build_silver(spark, "etablissements", b, silver, 2026)
    assert r.new_rows == 1 and r.total_rows == 2
    assert store.current().facts["bronze_batch"] == batch_id_of(datetime(2026, 3, 1))


def test_two_runs_equal_one_run_at_job_level(spark, scratch):
    rows1 = [etab_row(f"{i:014d}", cp=f"{75 + i % 3}{i % 10}{i % 7}0") for i in range(0, 20)]
    rows2 = [etab_row(f"{i:014d}", cp=f"{90 + i % 6}{i % 10}{i % 7}0") for i in range(20, 40)]
    # lake A: Silver after each batch
    a = f"{scratch}/a"
    ingest_bronze(spark, spark.createDataFrame(rows1, ETAB_SCHEMA), f"{a}/bronze", "etablissements", datetime(2026, 1, 1))
    build_silver(spark, "etablissements", f"{a}/bronze", f"{a}/silver", 2026)
    ingest_bronze(spark, spark.createDataFrame(rows2, ETAB_SCHEMA), f"{a}/bronze", "etablissements", datetime(2026, 2, 1))
    build_silver(spark, "etablissements", f"{a}/bronze", f"{a}/silver", 2026)
    # lake B: both batches first, one Silver run
    b = f"{scratch}/b"
    ingest_bronze(spark, spark.createDataFrame(rows1, ETAB_SCHEMA), f"{b}/bronze", "etablissements", datetime(2026, 1, 1))
    ingest_bronze(spark, spark.createDataFrame(rows2, ETAB_SCHEMA), f"{b}/bronze", "etablissements", datetime(2026, 2, 1))
    build_silver(spark, "etablissements", f"{b}/bronze", f"{b}/silver", 2026)
    sa = SnapshotStore(spark, f"{a}/silver/etablissements")
    sb = SnapshotStore(spark, f"{b}/silver/etablissements")
    got = sorted(map(tuple, sa.read().collect()))
    assert got == sorted(map(tuple, sb.read().collect())) and len(got) > 20
    assert current_mark(sa) == current_mark(sb) == datetime(2026, 2, 1)


def test_empty_column_list_is_a_configuration_error():
    import dataclasses

    broken = dataclasses.replace(ESTABLISHMENTS, columns=())
    with pytest.raises(KeyError):
        broken.selected_columns
    assert ESTABLISHMENTS.selected_columns[-1] == "ingested_at"


def test_repeated_key_in_increment_falls_back_to_dedup(spark, scratch):
    # an externally written Bronze may repeat a key inside one batch: the
    # cheap path (no dedup) fails the uniqueness check, the dedup path wins
    b = f"{scratch}/bronze"
    rows = [etab_row("00000000000001", enseigne="a"), etab_row("00000000000001", enseigne="b")]
    bronze_df(spark, rows).withColumn("batch_id", F.lit(batch_id_of(datetime(2026, 1, 1)))).write.partitionBy(
        "batch_id"
    ).parquet(b)
    r = build_silver(spark, "etablissements", b, f"{scratch}/silver", 2026)
    got = SnapshotStore(spark, f"{scratch}/silver/etablissements").read().collect()
    assert r.total_rows == 1 and [x.enseigne1Etablissement for x in got] == ["b"]


def test_racing_writers_cannot_both_commit_a_version(spark, scratch):
    from registrum.sources import parquet as pq

    store = SnapshotStore(spark, f"{scratch}/t")
    store.publish(spark.createDataFrame([("a",)], "k string"), facts={"who": "first"})
    # another writer commits version 2 between our listing and our commit
    pq.write_text(spark, f"{scratch}/t/_commits/00000002", '{"who": "other", "segments": [1]}')
    real_head = store._head
    store._head = lambda: (store._load(1), 2)  # our writer still believes version 1 is current
    with pytest.raises(Exception):
        store.publish(spark.createDataFrame([("b",)], "k string"), facts={"who": "second"})
    store._head = real_head
    assert store.current().facts["who"] == "other"  # the winner's commit is intact


def _again(spark, b, rows, ts):
    """A Bronze batch written elsewhere, which may repeat keys."""
    df = bronze_df(spark, rows, ts).withColumn("batch_id", F.lit(batch_id_of(ts)))
    df.write.mode("append").partitionBy("batch_id").parquet(b)


def test_repeated_key_rewrites_its_bucket_only(spark, scratch):
    silver = f"{scratch}/silver"
    store = SnapshotStore(spark, f"{silver}/etablissements")
    rows = [etab_row(f"{i:014d}", enseigne=f"e{i}") for i in range(200)]
    b = _bronze(spark, scratch, rows, datetime(2026, 1, 1))
    build_silver(spark, "etablissements", b, silver, 2026, buckets=16)
    before = store.current()
    assert before.layout.buckets == 16 and len(before.paths) == 16 and before.facts["rows"] == 200
    changed = [etab_row(f"{i:014d}", enseigne="again") for i in (3, 77)] + [etab_row(f"{900:014d}", enseigne="new")]
    _again(spark, b, changed, datetime(2026, 2, 1))
    read = []
    real = SnapshotStore.rows_of
    SnapshotStore.rows_of = lambda self, *a, **k: read.append(out := real(self, *a, **k)) or out
    try:
        r = build_silver(spark, "etablissements", b, silver, 2026)
    finally:
        SnapshotStore.rows_of = real
    after = store.current()
    touched = {r[0] for r in spark.createDataFrame(changed[:2], ETAB_SCHEMA).select(before.layout.bucket()).collect()}
    gone = set(before.paths) - set(after.paths)
    assert {int(p.rsplit("=", 1)[1]) for p in gone} == touched and len(touched) == 2
    assert after.segments[-1].rows < 50 and r.total_rows == 201
    # nothing of another bucket was read: neither the keys nor the rows
    asked = touched | {r[0] for r in spark.createDataFrame(changed[2:], ETAB_SCHEMA).select(before.layout.bucket()).collect()}
    files = {f for df in read for f in df.inputFiles()}
    assert files and {int(f.split("_bucket=")[1].split("/")[0]) for f in files} <= asked
    # equal to the full merge
    old = clean(spark, rows)
    new = silver_increment(bronze_df(spark, changed, datetime(2026, 2, 1)), ESTABLISHMENTS, MARK_FLOOR, REGION_DEPARTMENTS, 2026)
    want = merge_last_wins(old, new, ESTABLISHMENTS).select(*store.read().columns)
    assert sorted(map(tuple, store.read().collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_crash_before_the_commit_of_a_bucket_rewrite(spark, scratch, monkeypatch):
    silver = f"{scratch}/silver"
    store = SnapshotStore(spark, f"{silver}/etablissements")
    b = _bronze(spark, scratch, [etab_row(f"{i:014d}", enseigne="a") for i in range(40)], datetime(2026, 1, 1))
    build_silver(spark, "etablissements", b, silver, 2026, buckets=4)
    _again(spark, b, [etab_row("00000000000005", enseigne="b")], datetime(2026, 2, 1))

    def crash(*a, **k):
        raise RuntimeError("driver lost after the write")

    real = SnapshotStore._commit
    monkeypatch.setattr(SnapshotStore, "_commit", crash)
    with pytest.raises(RuntimeError):
        build_silver(spark, "etablissements", b, silver, 2026)
    monkeypatch.setattr(SnapshotStore, "_commit", real)
    assert {x.enseigne1Etablissement for x in store.read().collect()} == {"a"}  # the version before, whole
    r = build_silver(spark, "etablissements", b, silver, 2026)
    got = {x.siret: x.enseigne1Etablissement for x in store.read().collect()}
    assert r.total_rows == len(got) == 40 and [k for k, v in got.items() if v == "b"] == ["00000000000005"]


def test_crash_between_commit_and_seal_loses_no_row(spark, scratch, monkeypatch):
    """The next Silver run seals what it has committed; a retry of that batch is refused, not lost."""
    import registrum.plans.silver as plan
    from registrum.plans.bronze import StaleBatch

    silver, half = f"{scratch}/silver", [etab_row(f"{i:014d}") for i in range(10)]
    b = _bronze(spark, scratch, half, datetime(2026, 1, 1))
    real = plan.seal
    monkeypatch.setattr(plan, "seal", lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
    with pytest.raises(RuntimeError):
        build_silver(spark, "etablissements", b, silver, 2026)
    monkeypatch.setattr(plan, "seal", real)
    assert build_silver(spark, "etablissements", b, silver, 2026).new_rows == 0
    whole = half + [etab_row(f"{i:014d}") for i in range(10, 20)]
    with pytest.raises(StaleBatch):
        _bronze(spark, scratch, whole, datetime(2026, 1, 1))
    _bronze(spark, scratch, whole, datetime(2026, 1, 2))
    assert build_silver(spark, "etablissements", b, silver, 2026).total_rows == 20


def test_retry_with_nothing_to_write_leaves_no_old_attempt(spark, scratch):
    b = _bronze(spark, scratch, [etab_row(f"{i:014d}") for i in range(5)], datetime(2026, 1, 1))
    empty = spark.createDataFrame([], ETAB_SCHEMA)
    assert ingest_bronze(spark, empty, b, "etablissements", datetime(2026, 1, 1)).total_rows == 0


def test_jobs_leave_nothing_staged(spark, scratch):
    from registrum.session import ensure_checkpoint_dir
    from registrum.sources import parquet as pq

    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/staged"
    before = pq.list_names(spark, folder)
    for day in (1, 2):
        rows = [etab_row(f"{i % 30:014d}", enseigne=f"{i}") for i in range(20 * day)]
        b = f"{scratch}/bronze"
        ingest_bronze(spark, spark.createDataFrame(rows, ETAB_SCHEMA), b, "etablissements", datetime(2026, 1, day), limit=18)
        build_silver(spark, "etablissements", b, f"{scratch}/silver", 2026)
    assert pq.list_names(spark, folder) == before


def test_rows_rewritten_over_many_runs_grow_like_n_log_n():
    import math

    from registrum.sources.store import Segment, carry

    segments, written, runs = [], 0, 200
    for i in range(runs):
        kept, taken, level = carry(segments, 8, 10**9)
        rows = 10 + sum(s.rows for s in taken)
        written += rows
        segments = [*kept, Segment(f"v={i:08d}", {0: rows}, i, not taken, level)]
    assert sum(s.rows for s in segments) == 10 * runs and len(segments) <= 8 * math.ceil(math.log(runs, 8))
    assert written <= 10 * runs * (1 + math.ceil(math.log(runs, 8)))
    # a run never carries more than the bound
    assert carry([Segment("v=00000001", {0: 60}), Segment("v=00000002", {0: 50})], 2, 100) == ([Segment("v=00000001", {0: 60}), Segment("v=00000002", {0: 50})], [], 0)


def test_gold_follows_carried_segments(spark, scratch):
    """Silver segments taken up by later ones do not force a rebuild of Gold."""
    from registrum.plans.gold import build_gold

    silver, b, modes = f"{scratch}/silver", f"{scratch}/bronze", []
    ul = spark.createDataFrame(
        [("123456789", None, "N", None, "PME", 5710.0, None, "A", date(1990, 1, 1), None)],
        "siren string, denominationUniteLegale string, nomUniteLegale string, prenom1UniteLegale string, "
        "categorieEntreprise string, categorieJuridiqueUniteLegale double, activitePrincipaleUniteLegale string, "
        "etatAdministratifUniteLegale string, dateCreationUniteLegale date, economieSocialeSolidaireUniteLegale string",
    )
    ingest_bronze(spark, ul, f"{scratch}/ul", "unites_legales", datetime(2026, 1, 1))
    build_silver(spark, "unites_legales", f"{scratch}/ul", silver, 2026)
    for day in range(1, 5):
        _bronze(spark, scratch, [etab_row(f"{day}{i:013d}") for i in range(3)], datetime(2026, 1, day))
        build_silver(spark, "etablissements", b, silver, 2026, max_segments=2)
        r = build_gold(spark, silver, f"{scratch}/gold")
        modes.append(r.mode)
        assert r.master_rows == 3 * day
    assert modes == ["replace", "append", "append", "append"]
