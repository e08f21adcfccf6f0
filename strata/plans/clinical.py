"""The ten clinical-trial domains of the dimensional model.

Build with ``clinical_entities()`` (needs an active Spark session to parse the
column lists).  Dimensions: DM (SCD2 ``dim_subject``), TA and TS (SCD1).  The
seven event domains are facts resolved to the ``dim_subject`` version valid
on their event date.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

from strata.plans.entities import EntitySpec

# Landing column lists, business keys, gold tables, surrogate key
# names and event-date columns of the ten domains (from the declared model).
DOMAINS = {
    "dm": dict(
        columns="STUDYID STRING, DOMAIN STRING, USUBJID STRING, SUBJID STRING, SITEID STRING, "
                "COUNTRY STRING, RFICDTC DATE, RFSTDTC DATE, RFENDTC DATE, AGE INT, AGEU STRING, "
                "SEX STRING, RACE STRING, ETHNIC STRING, ARM STRING, ARMCD STRING, ACTARM STRING, "
                "ACTARMCD STRING, MODIFIED_TS TIMESTAMP",
        keys="USUBJID", kind="dimension", scd_type=2, gold_table="dim_subject", sk="subject_sk",
        gold_first=("USUBJID", "STUDYID")),
    "ta": dict(
        columns="STUDYID STRING, DOMAIN STRING, ARMCD STRING, ARM STRING, TAETORD INT, ETCD STRING, "
                "ELEMENT STRING, MODIFIED_TS TIMESTAMP",
        keys="STUDYID, ARMCD, TAETORD", kind="dimension", scd_type=1, gold_table="dim_arm", sk="arm_sk"),
    "ts": dict(
        columns="STUDYID STRING, DOMAIN STRING, TSPARMCD STRING, TSPARM STRING, TSVAL STRING, "
                "MODIFIED_TS TIMESTAMP",
        keys="STUDYID, TSPARMCD", kind="dimension", scd_type=1, gold_table="dim_trial_summary", sk="ts_sk"),
    "sv": dict(
        columns="STUDYID STRING, DOMAIN STRING, USUBJID STRING, VISITNUM DECIMAL(5,1), VISIT STRING, "
                "SVSTDTC DATE, SVENDTC DATE, PROTOCOLDEV STRING, MODIFIED_TS TIMESTAMP",
        keys="USUBJID, VISITNUM", kind="fact", gold_table="fact_subject_visit", sk="visit_sk",
        event_date="SVSTDTC"),
    "vs": dict(
        columns="STUDYID STRING, DOMAIN STRING, USUBJID STRING, VSSEQ INT, VSTESTCD STRING, VSTEST STRING, "
                "VSORRES DECIMAL(12,3), VSORRESU STRING, VISITNUM DECIMAL(5,1), VISIT STRING, VSDTC DATE, "
                "MODIFIED_TS TIMESTAMP",
        keys="USUBJID, VSSEQ", kind="fact", gold_table="fact_vital_sign", sk="vital_sk", event_date="VSDTC"),
    "lb": dict(
        columns="STUDYID STRING, DOMAIN STRING, USUBJID STRING, LBSEQ INT, LBTESTCD STRING, LBTEST STRING, "
                "LBCAT STRING, LBORRES DECIMAL(12,3), LBORRESU STRING, LBORNRLO DECIMAL(12,3), "
                "LBORNRHI DECIMAL(12,3), LBNRIND STRING, VISITNUM DECIMAL(5,1), VISIT STRING, LBDTC DATE, "
                "MODIFIED_TS TIMESTAMP",
        keys="USUBJID, LBSEQ", kind="fact", gold_table="fact_lab_result", sk="lab_sk", event_date="LBDTC"),
    "eg": dict(
        columns="STUDYID STRING, DOMAIN STRING, USUBJID STRING, EGSEQ INT, EGTESTCD STRING, EGTEST STRING, "
                "EGORRES DECIMAL(12,3), EGORRESU STRING, VISITNUM DECIMAL(5,1), VISIT STRING, EGDTC DATE, "
                "MODIFIED_TS TIMESTAMP",
        keys="USUBJID, EGSEQ", kind="fact", gold_table="fact_ecg", sk="ecg_sk", event_date="EGDTC"),
    "ec": dict(
        columns="STUDYID STRING, DOMAIN STRING, USUBJID STRING, ECSEQ INT, ECTRT STRING, "
                "ECDOSE DECIMAL(10,2), ECDOSU STRING, ECROUTE STRING, ECSTDTC DATE, ECENDTC DATE, "
                "VISITNUM DECIMAL(5,1), VISIT STRING, MODIFIED_TS TIMESTAMP",
        keys="USUBJID, ECSEQ", kind="fact", gold_table="fact_exposure", sk="exposure_sk", event_date="ECSTDTC"),
    "cm": dict(
        columns="STUDYID STRING, DOMAIN STRING, USUBJID STRING, CMSEQ INT, CMTRT STRING, CMDECOD STRING, "
                "CMDOSE DECIMAL(10,2), CMDOSU STRING, CMROUTE STRING, CMSTDTC DATE, CMENDTC DATE, "
                "CMINDC STRING, MODIFIED_TS TIMESTAMP",
        keys="USUBJID, CMSEQ", kind="fact", gold_table="fact_conmed", sk="conmed_sk", event_date="CMSTDTC"),
    "ds": dict(
        columns="STUDYID STRING, DOMAIN STRING, USUBJID STRING, DSSEQ INT, DSTERM STRING, DSDECOD STRING, "
                "DSCAT STRING, DSSTDTC DATE, MODIFIED_TS TIMESTAMP",
        keys="USUBJID, DSSEQ", kind="fact", gold_table="fact_disposition", sk="disposition_sk",
        event_date="DSSTDTC"),
}
SUBJECT_DIMENSION = "dm"
SUBJECT_KEY = "USUBJID"


def clinical_entities() -> dict[str, EntitySpec]:
    out = {}
    for name, d in DOMAINS.items():
        d = dict(d)
        schema = StructType.fromDDL(d.pop("columns"))
        if d["kind"] == "fact":
            d.update(dimension=SUBJECT_DIMENSION, link_key=SUBJECT_KEY)
        out[name] = EntitySpec(name=name, landing_name=name.upper(), schema=schema, **d)
    return out
