"""Log-to-table specs of the cleaned layer: one line of text per table.

Field suffixes: ``*`` integer, absent or malformed gives 0; ``^`` score with one decimal, half up, absent gives 0.0;
``?`` integer of the table, malformed gives null; ``$`` decimal(10,4); ``@`` timestamp; none is text.
``name<key`` reads another JSON key. ``name=rule`` applies a rule of ``etl.RULES``.
"""

from __future__ import annotations

from dataclasses import dataclass

# Logs, tables, field names and types of the cleaned layer.
_SPECS = """
memberRegtype | dwd_member_regtype | append | dt dn | uid* appkey appregurl bdp_uuid createtime domain isranreg regsource regsourcename<regsource=source_label websiteid* dt dn
member | dwd_member | append | dt dn | uid* ad_id* birthday email fullname=mask_name iconurl lastlogin mailaddr memberlevel password=redact paymoney phone=mask_phone qq register regupdatetime unitname userip zipcode dt dn
baseadlog | dwd_base_ad | overwrite | dn | adid* adname dn
baswewebsite | dwd_base_website | overwrite | dn | siteid* sitename siteurl delete* createtime creator dn
pcentermempaymoney | dwd_pcentermempaymoney | append | dt dn | uid* paymoney siteid* vip_id* dt dn
pcenterMemViplevel | dwd_vip_level | overwrite | dn | vip_id* vip_level start_time end_time last_modify_time max_free min_free next_level operator dn
QzChapter | dwd_qz_chapter | append | dt dn | chapterid* chapterlistid* chaptername sequence showstatus status creator createtime courseid* chapternum* outchapterid* dt dn
QzChapterList | dwd_qz_chapter_list | append | dt dn | chapterlistid* chapterlistname courseid* chapterallnum* sequence status creator createtime dt dn
QzPoint | dwd_qz_point | append | dt dn | pointid* courseid* pointname pointyear chapter creator createtime status modifystatus excisenum* pointlistid* chapterid* sequence pointdescribe pointlevel typelist score^ thought remid pointnamelist typelistids pointlist dt dn
QzPointQuestion | dwd_qz_point_question | append | dt dn | pointid* questionid* questype*<questtype creator createtime dt dn
QzSiteCourse | dwd_qz_site_course | append | dt dn | sitecourseid* siteid* courseid* sitecoursename coursechapter sequence status creator createtime helppaperstatus servertype boardid* showstatus dt dn
QzCourse | dwd_qz_course | append | dt dn | courseid* majorid* coursename coursechapter sequence isadvc creator createtime status chapterlistid* pointlistid* dt dn
QzCourseEduSubject | dwd_qz_course_edusubject | append | dt dn | courseeduid* edusubjectid* courseid* creator createtime majorid* dt dn
QzWebsite | dwd_qz_website | append | dt dn | siteid* sitename domain sequence multicastserver templateserver status creator createtime multicastgateway multicastport dt dn
QzMajor | dwd_qz_major | append | dt dn | majorid* businessid* siteid* majorname shortname status sequence creator createtime columm_sitetype dt dn
QzBusiness | dwd_qz_business | append | dt dn | businessid* businessname sequence status creator createtime siteid* dt dn
QzPaperView | dwd_qz_paper_view | append | dt dn | paperviewid* paperid* paperviewname paperparam openstatus explainurl iscontest contesttime conteststarttime contestendtime contesttimelimit dayiid* status creator createtime paperviewcatid* modifystatus description papertype downurl paperuse paperdifficult testreport paperuseshow dt dn
QzCenterPaper | dwd_qz_center_paper | append | dt dn | paperviewid* centerid* openstatus sequence creator createtime dt dn
QzPaper | dwd_qz_paper | append | dt dn | paperid* papercatid* courseid* paperyear chapter suitnum papername status creator createtime totalscore^ chapterid* chapterlistid* dt dn
QzCenter | dwd_qz_center | append | dt dn | centerid* centername centeryear centertype openstatus centerparam description creator createtime sequence provideuser centerviewtype stage dt dn
QzQuestion | dwd_qz_question | append | dt dn | questionid* parentid* questypeid* quesviewtype* content answer analysis limitminute score^ splitscore^ status optnum* lecture creator createtime modifystatus attanswer questag vanalysisaddr difficulty quesskill vdeoaddr dt dn
QzQuestionType | dwd_qz_question_type | append | dt dn | quesviewtype* viewtypename questypeid* description status creator createtime papertypename sequence remark splitscoretype dt dn
QzMemberPaperQuestion | dwd_qz_member_paper_question | append | dt dn | userid* paperviewid* chapterid* sitecourseid* questionid* majorid* useranswer istrue lasttime opertype paperid* spendtime* score^ question_answer* dt dn
salecourse | dwd_sale_course | append | dt dn | courseid? coursename status pointlistid? majorid? chapterid? chaptername edusubjectid? edusubjectname teacherid? teachername coursemanager money$ dt dn
coursepay | dwd_course_pay | append | dt dn | orderid discount$ paymoney$ createtime@ dt dn
coursepay | dwd_course_pay_cluster | bucketed | dt dn | orderid discount$ paymoney$ createtime@ dt dn
courseshoppingcart | dwd_course_shopping_cart | append | dt dn | courseid? orderid coursename discount$ sellmoney$ createtime@ dt dn
courseshoppingcart | dwd_course_shopping_cart_cluster | bucketed | dt dn | courseid? orderid coursename discount$ sellmoney$ createtime@ dt dn
"""

# Fixed value: bucket count of the tables joined on orderid.
ORDER_BUCKETS = 10

_KINDS = {"*": "int", "^": "decimal(10,1)", "?": "int", "$": "decimal(10,4)", "@": "timestamp"}


@dataclass(frozen=True)
class Field:
    name: str
    kind: str  # one of the suffixes, or "" for text
    key: str
    rule: str

    @property
    def type(self) -> str:
        return _KINDS.get(self.kind, "string")


@dataclass(frozen=True)
class LogSpec:
    log: str
    table: str
    mode: str
    partition_by: tuple[str, ...]
    fields: tuple[Field, ...]

    @property
    def schema(self) -> str:
        return ", ".join(f"`{f.name}` {f.type}" for f in self.fields)

    @property
    def keys(self) -> list[str]:
        return list(dict.fromkeys(f.key for f in self.fields if f.rule != "redact"))


def _field(text: str) -> Field:
    text, _, rule = text.partition("=")
    name, _, key = text.partition("<")
    kind = name[-1] if name[-1] in _KINDS else ""
    name = name.rstrip("*^?$@")
    return Field(name, kind, key or name, rule)


def _parse() -> dict[str, LogSpec]:
    specs = {}
    for line in _SPECS.strip().splitlines():
        log, table, mode, parts, fields = (x.strip() for x in line.split("|"))
        specs[table] = LogSpec(log, table, mode, tuple(parts.split()), tuple(_field(f) for f in fields.split()))
    return specs


SPECS = _parse()
