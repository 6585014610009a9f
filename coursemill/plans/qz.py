"""Question-bank subject area: five dimensions, the answer fact and seven reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from coursemill.functions.columns import ratio, score_band
from coursemill.operators.grouping import dense_top, joined_lists
from coursemill.operators.joins import broadcast_within


def _day(df: DataFrame, dt: str, columns: str) -> DataFrame:
    """``dt`` slice of a table with columns renamed by ``old:new`` and without ``dt`` unless asked for."""
    return df.where(F.col("dt") == dt).select(*[_renamed(c) for c in columns.split()])


def _renamed(text: str) -> Column:
    old, _, new = text.partition(":")
    return F.col(old).alias(new or old)


# Columns the dimensions take from their tables, ``old:new`` where renamed.
_CHAPTER = (
    "chapterid chapterlistid chaptername sequence showstatus status creator:chapter_creator "
    "createtime:chapter_createtime courseid:chapter_courseid chapternum outchapterid dt dn"
)
_CHAPTER_LIST = "chapterlistid chapterlistname chapterallnum dn"
_POINT = (
    "pointid pointname pointyear chapter excisenum pointlistid chapterid pointdescribe pointlevel typelist "
    "score:point_score thought remid pointnamelist typelistids pointlist dn"
)
_POINT_QUESTION = "pointid questionid questype dn"
_SITE_COURSE = (
    "sitecourseid siteid courseid sitecoursename coursechapter sequence status creator:sitecourse_creator "
    "createtime:sitecourse_createtime helppaperstatus servertype boardid showstatus dt dn"
)
_COURSE = "courseid majorid coursename isadvc chapterlistid pointlistid dn"
_EDU_SUBJECT = "courseeduid edusubjectid courseid dn"
_MAJOR = (
    "majorid businessid siteid majorname shortname status sequence creator:major_creator "
    "createtime:major_createtime dt dn"
)
_WEBSITE = "siteid sitename domain multicastserver templateserver multicastgateway multicastport dn"
_BUSINESS = "businessid businessname dn"
_PAPER_VIEW = (
    "paperviewid paperid paperviewname paperparam openstatus explainurl iscontest contesttime conteststarttime "
    "contestendtime contesttimelimit dayiid status creator:paper_view_creator createtime:paper_view_createtime "
    "paperviewcatid modifystatus description paperuse paperdifficult testreport paperuseshow dt dn"
)
_CENTER_PAPER = "paperviewid sequence centerid dn"
_CENTER = "centerid centername centeryear centertype provideuser centerviewtype stage dn"
_PAPER = "paperid papercatid courseid paperyear suitnum papername totalscore chapterid chapterlistid dn"
_QUESTION = (
    "questionid parentid questypeid quesviewtype content answer analysis limitminute score splitscore status optnum "
    "lecture creator createtime modifystatus attanswer questag vanalysisaddr difficulty quesskill vdeoaddr dt dn"
)
_QUESTION_TYPE = "questypeid viewtypename description papertypename remark splitscoretype dn"

# Columns the fact takes from its table and from each dimension.
_FACT = (
    "userid paperviewid chapterid sitecourseid questionid majorid useranswer istrue lasttime opertype spendtime score "
    "question_answer:user_question_answer dt dn"
)
_FACT_CHAPTER = (
    "chapterid chaptername chapternum chapterallnum outchapterid chapterlistname pointid questype pointname pointyear "
    "chapter excisenum pointlistid pointdescribe pointlevel typelist point_score thought remid pointnamelist "
    "typelistids pointlist chapterlistid dn"
)
_FACT_COURSE = (
    "sitecourseid siteid courseid sitecoursename coursechapter sequence:course_sequence status:course_status "
    "sitecourse_creator:course_creator sitecourse_createtime:course_createtime helppaperstatus servertype boardid "
    "showstatus coursename isadvc courseeduid edusubjectid dn"
)
_FACT_MAJOR = (
    "majorid businessid majorname shortname status:major_status sequence:major_sequence major_creator "
    "major_createtime businessname sitename domain multicastserver templateserver multicastgateway multicastport dn"
)
_FACT_PAPER = (
    "paperviewid paperid paperviewname paperparam openstatus explainurl iscontest contesttime conteststarttime "
    "contestendtime contesttimelimit dayiid status:paper_status paper_view_creator paper_view_createtime "
    "paperviewcatid modifystatus description paperuse testreport centerid sequence:paper_sequence centername "
    "centeryear centertype provideuser centerviewtype stage:paper_stage papercatid paperyear suitnum papername "
    "totalscore dn"
)
_FACT_QUESTION = (
    "questionid parentid:question_parentid questypeid quesviewtype content:question_content answer:question_answer "
    "analysis:question_analysis limitminute:question_limitminute splitscore lecture creator:question_creator "
    "createtime:question_createtime modifystatus:question_modifystatus attanswer:question_attanswer "
    "questag:question_questag vanalysisaddr:question_vanalysisaddr difficulty:question_difficulty quesskill vdeoaddr "
    "description:question_description splitscoretype:question_splitscoretype dn"
)
# Columns of the fact, in its order.
FACT_COLUMNS = (
    "userid courseid questionid useranswer istrue lasttime opertype paperid spendtime chapterid chaptername chapternum "
    "chapterallnum outchapterid chapterlistname pointid questype pointyear chapter pointname excisenum pointdescribe "
    "pointlevel typelist point_score thought remid pointnamelist typelistids pointlist sitecourseid siteid "
    "sitecoursename coursechapter course_sequence course_status course_creator course_createtime servertype "
    "helppaperstatus boardid showstatus majorid coursename isadvc chapterlistid pointlistid courseeduid edusubjectid "
    "businessid majorname shortname major_status major_sequence major_creator major_createtime businessname sitename "
    "domain multicastserver templateserver multicastgateway multicastport paperviewid paperviewname paperparam "
    "openstatus explainurl iscontest contesttime conteststarttime contestendtime contesttimelimit dayiid paper_status "
    "paper_view_creator paper_view_createtime paperviewcatid modifystatus description paperuse testreport centerid "
    "paper_sequence centername centeryear centertype provideuser centerviewtype paper_stage papercatid paperyear "
    "suitnum papername totalscore question_parentid questypeid quesviewtype question_content question_answer "
    "question_analysis question_limitminute score splitscore lecture question_creator question_createtime "
    "question_modifystatus question_attanswer question_questag question_vanalysisaddr question_difficulty quesskill "
    "vdeoaddr question_description question_splitscoretype user_question_answer dt dn"
).split()

# Columns of the dimension tables, in their order.
_CHAPTER_DIM = (
    "chapterid chapterlistid chaptername sequence showstatus status chapter_creator chapter_createtime "
    "chapter_courseid chapternum chapterallnum outchapterid chapterlistname pointid questionid questype pointname "
    "pointyear chapter excisenum pointlistid pointdescribe pointlevel typelist point_score thought remid "
    "pointnamelist typelistids pointlist dt dn"
).split()
_COURSE_DIM = (
    "sitecourseid siteid courseid sitecoursename coursechapter sequence status sitecourse_creator "
    "sitecourse_createtime helppaperstatus servertype boardid showstatus majorid coursename isadvc chapterlistid "
    "pointlistid courseeduid edusubjectid dt dn"
).split()
_MAJOR_DIM = (
    "majorid businessid siteid majorname shortname status sequence major_creator major_createtime businessname "
    "sitename domain multicastserver templateserver multicastgateway multicastport dt dn"
).split()
_PAPER_DIM = (
    "paperviewid paperid paperviewname paperparam openstatus explainurl iscontest contesttime conteststarttime "
    "contestendtime contesttimelimit dayiid status paper_view_creator paper_view_createtime paperviewcatid "
    "modifystatus description paperuse paperdifficult testreport paperuseshow centerid sequence centername "
    "centeryear centertype provideuser centerviewtype stage papercatid courseid paperyear suitnum papername "
    "totalscore chapterid chapterlistid dt dn"
).split()
_QUESTION_DIM = (
    "questionid parentid questypeid quesviewtype content answer analysis limitminute score splitscore status "
    "optnum lecture creator createtime modifystatus attanswer questag vanalysisaddr difficulty quesskill vdeoaddr "
    "viewtypename papertypename description remark splitscoretype dt dn"
).split()


def chapter_dim(t: Mapping[str, DataFrame], dt: str) -> DataFrame:
    """Chapters with their list, points and the questions of each point: one row per point question."""
    return (
        _day(t["chapter"], dt, _CHAPTER)
        .join(_day(t["chapter_list"], dt, _CHAPTER_LIST), ["chapterlistid", "dn"])
        .join(_day(t["point"], dt, _POINT), ["chapterid", "dn"])
        .join(_day(t["point_question"], dt, _POINT_QUESTION), ["pointid", "dn"])
        .select(*_CHAPTER_DIM)
    )


def course_dim(t: Mapping[str, DataFrame], dt: str) -> DataFrame:
    return (
        _day(t["site_course"], dt, _SITE_COURSE)
        .join(_day(t["course"], dt, _COURSE), ["courseid", "dn"])
        .join(_day(t["course_edusubject"], dt, _EDU_SUBJECT), ["courseid", "dn"])
        .select(*_COURSE_DIM)
    )


def major_dim(t: Mapping[str, DataFrame], dt: str) -> DataFrame:
    return (
        _day(t["major"], dt, _MAJOR)
        .join(_day(t["website"], dt, _WEBSITE), ["siteid", "dn"])
        .join(_day(t["business"], dt, _BUSINESS), ["businessid", "dn"])
        .select(*_MAJOR_DIM)
    )


def paper_dim(t: Mapping[str, DataFrame], dt: str) -> DataFrame:
    return (
        _day(t["paper_view"], dt, _PAPER_VIEW)
        .join(_day(t["center_paper"], dt, _CENTER_PAPER), ["paperviewid", "dn"], "left")
        .join(_day(t["center"], dt, _CENTER), ["centerid", "dn"], "left")
        .join(_day(t["paper"], dt, _PAPER), ["paperid", "dn"])
        .select(*_PAPER_DIM)
    )


def question_dim(t: Mapping[str, DataFrame], dt: str) -> DataFrame:
    return (
        _day(t["question"], dt, _QUESTION)
        .join(_day(t["question_type"], dt, _QUESTION_TYPE), ["questypeid", "dn"])
        .select(*_QUESTION_DIM)
    )


_FACT_DIMS = {
    "course": ("sitecourseid", _FACT_COURSE),
    "major": ("majorid", _FACT_MAJOR),
    "paper": ("paperviewid", _FACT_PAPER),
    "question": ("questionid", _FACT_QUESTION),
    "chapter": ("chapterid", _FACT_CHAPTER),
}


def answer_fact(answers: DataFrame, dims: Mapping[str, DataFrame], dt: str) -> DataFrame:
    """Answers joined to all five dimensions; the chapter dimension has a row per point question, so rows fan out.

    A row takes along through every later shuffle what it was joined to before, so answers without a partner go first, while
    a row is only its own columns, and the fan-out comes after all other shuffles. Courses and majors that were measured to be
    small are broadcast: their keys filter the answers first, and their columns are joined last of all and are
    never shuffled with a row. Inner joins commute, so the result does not depend on it.

    No other side is broadcast: the size of stored files, which Spark goes by, tells little of the rows that the driver would hold.
    """
    sides = {name: _day(dims[name], dt, columns) for name, (_, columns) in _FACT_DIMS.items()}
    on = {name: [key, "dn"] for name, (key, _) in _FACT_DIMS.items()}
    sent = {name: broadcast_within(sides[name]) for name in ("major", "course")}
    small = [name for name, side in sent.items() if side is not sides[name]]
    rows = _day(answers, dt, _FACT)
    for name in small:
        rows = rows.join(F.broadcast(sides[name].select(*on[name])), on[name], "left_semi")
    rows = rows.join(sides["chapter"].select(*on["chapter"]).hint("merge"), on["chapter"], "left_semi")
    for name in [*(n for n in _FACT_DIMS if n not in small), *small]:
        rows = rows.join(sent[name] if name in small else sides[name].hint("merge"), on[name])
    return rows.select(*FACT_COLUMNS)


_PAPER_KEYS = ["paperviewid", "paperviewname", "dt", "dn"]
_RANKED = (
    "userid paperviewid paperviewname chaptername pointname sitecoursename coursename majorname shortname sitename "
    "papername score dt dn"
).split()


def averages_order() -> list[Column]:
    return [F.col("avgscore").desc(), F.col("avgspendtime").desc(), F.col("paperviewid")]


BANDS_ORDER = ("paperviewid", "score_segment", "part")


def errors_order() -> list[Column]:
    return [F.col("errcount").desc(), F.col("questionid")]


def _fact_day(fact: DataFrame, dt: str) -> DataFrame:
    return fact.where(F.col("dt") == dt)


def paper_averages(fact: DataFrame, dt: str) -> DataFrame:
    """Average score and time spent per paper, best first."""
    return (
        _fact_day(fact, dt)
        .groupBy(*_PAPER_KEYS)
        .agg(
            F.avg("score").cast("decimal(4,1)").alias("avgscore"),
            F.avg("spendtime").cast("decimal(10,2)").alias("avgspendtime"),
        )
        .select("paperviewid", "paperviewname", "avgscore", "avgspendtime", "dt", "dn")
        .orderBy(*averages_order())
    )


def paper_extremes(fact: DataFrame, dt: str) -> DataFrame:
    return (
        _fact_day(fact, dt)
        .groupBy(*_PAPER_KEYS)
        .agg(
            F.max("score").cast("decimal(4,1)").alias("maxscore"), F.min("score").cast("decimal(4,1)").alias("minscore")
        )
        .select("paperviewid", "paperviewname", "maxscore", "minscore", "dt", "dn")
    )


def paper_top_users(fact: DataFrame, dt: str, k: int = 3, *, descending: bool = True) -> DataFrame:
    """Answers among the ``k`` best (or worst) distinct scores of their paper; ties are all kept."""
    rows = _fact_day(fact, dt).select(*_RANKED)
    ranked = dense_top(rows, ["paperviewid"], "score", k, descending=descending)
    return ranked.select(*[c for c in _RANKED if c not in ("dt", "dn")], "rk", "dt", "dn")


def paper_score_bands(fact: DataFrame, dt: str, parts: int = 1) -> DataFrame:
    """User ids per paper and score band as a comma list (see ``joined_lists`` for what ``part`` means)."""
    rows = _fact_day(fact, dt).select(*_PAPER_KEYS, "userid", score_band("score").alias("score_segment"))
    keys = ["paperviewid", "paperviewname", "score_segment", "dt", "dn"]
    lists = joined_lists(rows, keys, "userid", "userids", parts=parts)
    return lists.select(
        "paperviewid", "paperviewname", "score_segment", "part", "userids", "dt", "dn"
    ).orderBy(*BANDS_ORDER)


def paper_pass_rates(fact: DataFrame, dt: str) -> DataFrame:
    """Failed (0 to 60) and passed (above 60) answers per paper; a paper without either one does not appear.

    Both counts come from one aggregation. A paper has one row per name among the failed, with all passes of the paper.
    """
    score = F.col("score")
    counts = (
        _fact_day(fact, dt)
        .groupBy("paperviewid", "paperviewname", "dt", "dn")
        .agg(
            F.count_if(score.between(0, 60)).alias("unpasscount"),
            F.count_if(score > 60).alias("_passed"),
        )
    )
    # a window over the few names of one paper, on rows that are already counts
    passed = F.sum("_passed").over(W.partitionBy("paperviewid", "dn"))
    return (
        counts.withColumn("passcount", passed)
        .where((F.col("unpasscount") > 0) & (F.col("passcount") > 0))
        .withColumn("rate", ratio("passcount", F.col("passcount") + F.col("unpasscount")))
        .select("paperviewid", "paperviewname", "unpasscount", "passcount", "rate", "dt", "dn")
    )


def question_error_rates(fact: DataFrame, dt: str) -> DataFrame:
    """Wrong and right answers per question, most errors first; a question without either one does not appear."""
    answer = F.col("user_question_answer").cast("string")
    return (
        _fact_day(fact, dt)
        .groupBy("questionid", "dt", "dn")
        .agg(F.count_if(answer == "0").alias("errcount"), F.count_if(answer == "1").alias("rightcount"))
        .where((F.col("errcount") > 0) & (F.col("rightcount") > 0))
        .withColumn("rate", ratio("errcount", F.col("errcount") + F.col("rightcount")))
        .select("questionid", "errcount", "rightcount", "rate", "dt", "dn")
        .orderBy(*errors_order())
    )
