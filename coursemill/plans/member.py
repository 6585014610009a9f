"""Member subject area: wide table, payment history and registration reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursemill.functions.columns import money
from coursemill.operators.grouping import count_by, pick_one, top_rows

# Columns of the wide table, in its order.
WIDE_COLUMNS = (
    "uid ad_id fullname iconurl lastlogin mailaddr memberlevel password paymoney phone qq register regupdatetime "
    "unitname userip zipcode appkey appregurl bdp_uuid reg_createtime isranreg regsource regsourcename adname siteid "
    "sitename siteurl site_delete site_createtime site_creator vip_id vip_level vip_start_time vip_end_time "
    "vip_last_modify_time vip_max_free vip_min_free vip_next_level vip_operator dt dn"
).split()

_MEMBER = (
    "uid ad_id fullname iconurl lastlogin mailaddr memberlevel password phone qq register regupdatetime unitname "
    "userip zipcode dt dn"
).split()
_REGISTRATION = "uid appkey appregurl bdp_uuid isranreg regsource regsourcename dn".split()


def registrations(rows: DataFrame) -> DataFrame:
    """What the wide table takes from a registration."""
    return rows.select(*_REGISTRATION, F.col("createtime").alias("reg_createtime"), "websiteid")


def payments(rows: DataFrame) -> DataFrame:
    """What the wide table takes from a payment."""
    return rows.select("uid", "dn", "vip_id", money("paymoney").alias("paymoney"))


def first_registrations(rows: DataFrame) -> DataFrame:
    """One registration per member and site. The result of parts, put together and reduced again, is that of the whole."""
    return pick_one(rows, ["uid", "dn"])


def paid_by_level(rows: DataFrame) -> DataFrame:
    """Money per member, site and level id; reducing parts and then their results gives the same. Levels are not joined
    yet, so a level that changes later changes what is shown and not what is kept."""
    total = F.sum("paymoney").cast("decimal(20,4)").alias("paymoney")
    return rows.groupBy("uid", "dn", "vip_id").agg(total)


def _payments(paid: DataFrame, vip: DataFrame, *, id_from_payment: bool) -> DataFrame:
    """Money and level facts per member and site, so that no payment is counted once per registration."""
    levels = vip.select(
        F.col("vip_id").alias("level_id"),
        "vip_level",
        F.col("start_time").alias("vip_start_time"),
        F.col("end_time").alias("vip_end_time"),
        F.col("last_modify_time").alias("vip_last_modify_time"),
        F.col("max_free").alias("vip_max_free"),
        F.col("min_free").alias("vip_min_free"),
        F.col("next_level").alias("vip_next_level"),
        F.col("operator").alias("vip_operator"),
        F.col("dn").alias("level_dn"),
    )
    joined = paid.join(levels, (paid["vip_id"] == levels["level_id"]) & (paid["dn"] == levels["level_dn"]), "left")
    shown_id = F.col("vip_id") if id_from_payment else F.col("level_id")
    first = F.min(F.struct(shown_id.alias("vip_id"), "vip_max_free", "vip_min_free", "vip_operator"))
    return (
        joined.groupBy("uid", "dn")
        .agg(
            F.sum("paymoney").cast("decimal(20,4)").alias("paymoney"),
            F.max("vip_level").alias("vip_level"),
            F.min("vip_start_time").alias("vip_start_time"),
            F.max("vip_end_time").alias("vip_end_time"),
            F.max("vip_last_modify_time").alias("vip_last_modify_time"),
            F.max("vip_next_level").alias("vip_next_level"),
            first.alias("f"),
        )
        .select("*", "f.*")
        .drop("f")
    )


def wide_member(
    member: DataFrame,
    registration: DataFrame,
    ad: DataFrame,
    website: DataFrame,
    pay: DataFrame,
    vip: DataFrame,
    dt: str,
    *,
    ids_from_facts: bool = False,
) -> DataFrame:
    """One wide row per member, site and day: left joins to registration, ad, website, payments and level.

    Member, registration and payments are reduced to one row per (uid, dn) first. All three are then hash-partitioned
    on the same keys, so their joins need no further shuffle, and no join sees a hot key. Attributes come from the
    smallest row instead of whichever row arrives first. ``ids_from_facts`` shows the website and level ids of the
    registration and the payment even when their lookup finds nothing, and money of non-payers as 0.
    """
    registered, paid = first_registrations(registrations(registration)), payments(pay)
    return wide_from_facts(member, registered, ad, website, paid, vip, dt, ids_from_facts=ids_from_facts)


def wide_from_facts(
    member: DataFrame,
    registered: DataFrame,
    ad: DataFrame,
    website: DataFrame,
    paid: DataFrame,
    vip: DataFrame,
    dt: str,
    *,
    ids_from_facts: bool = False,
) -> DataFrame:
    """``wide_member`` from registrations that are reduced already (``first_registrations``) and from payments as they
    are (``payments``) or reduced (``paid_by_level``)."""
    members = pick_one(member.where(F.col("dt") == dt).select(*_MEMBER), ["uid", "dn"])
    ads = ad.select(F.col("adid").alias("ad_id"), "adname", "dn")
    sites = website.select(
        F.col("siteid").alias("websiteid"),
        F.col("siteid").alias("found_siteid"),
        "sitename",
        "siteurl",
        F.col("delete").alias("site_delete"),
        F.col("createtime").alias("site_createtime"),
        F.col("creator").alias("site_creator"),
        "dn",
    )
    wide = (
        members.join(registered, ["uid", "dn"], "left")
        .join(_payments(paid, vip, id_from_payment=ids_from_facts), ["uid", "dn"], "left")
        .join(ads, ["ad_id", "dn"], "left")
        .join(sites, ["websiteid", "dn"], "left")
        .withColumn("siteid", F.col("websiteid") if ids_from_facts else F.col("found_siteid"))
    )
    if ids_from_facts:
        wide = wide.withColumn("paymoney", F.coalesce("paymoney", F.lit(0).cast("decimal(20,4)")))
    return wide.select(*WIDE_COLUMNS)


# Report name -> counted attribute.
COUNT_REPORTS = {
    "register_appregurlnum": "appregurl",
    "register_sitenamenum": "sitename",
    "register_regsourcenamenum": "regsourcename",
    "register_adnamenum": "adname",
    "register_memberlevelnum": "memberlevel",
    "register_viplevelnum": "vip_level",
}


def member_counts(wide: DataFrame, dt: str, attribute: str) -> DataFrame:
    """Members per value of ``attribute``, day and site."""
    day = wide.where(F.col("dt") == dt)
    return count_by(day, [attribute, "dt", "dn"], "uid", "num").select(attribute, "num", "dt", "dn")


PAYERS_ORDER = ("memberlevel", "rownum", "dn")


def top_payers(wide: DataFrame, dt: str, k: int = 3) -> DataFrame:
    """The ``k`` best paying members per site and level, equal amounts ordered by uid."""
    day = wide.where(F.col("dt") == dt).withColumn("paymoney", F.col("paymoney").try_cast("decimal(10,4)"))
    best = top_rows(day, ["dn", "memberlevel"], [F.col("paymoney").desc(), F.col("uid").asc()], k)
    return best.select(
        "uid", "memberlevel", "register", "appregurl", "regsourcename", "adname", "sitename", "vip_level", "paymoney",
        "rownum", "dt", "dn",
    ).orderBy(*PAYERS_ORDER)
