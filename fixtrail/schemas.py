"""The eight tables and the nested advisory feed as Spark schema texts (DDL)."""

from __future__ import annotations

from .functions.diffs import PARSED_DIFF

LANG_TEXT = "array<struct<lang:string,value:string>>"
REFERENCES = "array<struct<url:string,name:string,refsource:string,tags:array<string>>>"
PROBLEM_TYPES = f"array<struct<description:{LANG_TEXT}>>"
# The tree of affected products is kept one level deep; deeper children stay JSON text. The limits of a match's versions
# are fixed names of the feed.
NODES = (
    "array<struct<operator:string,children:array<string>,"
    "cpe_match:array<struct<vulnerable:boolean,cpe23Uri:string,versionStartIncluding:string,versionStartExcluding:string,"
    "versionEndIncluding:string,versionEndExcluding:string,cpe_name:array<string>>>>>"
)

# Columns whose names are fixed values of the data model, in stored order.
CVE = (
    "cve_id string, published_date timestamp, last_modified_date timestamp, "
    f"description {LANG_TEXT}, nodes {NODES}, severity string, "
    "obtain_all_privilege boolean, obtain_user_privilege boolean, obtain_other_privilege boolean, "
    "user_interaction_required boolean, "
    "cvss2_vector_string string, cvss2_access_vector string, cvss2_access_complexity string, "
    "cvss2_authentication string, cvss2_confidentiality_impact string, cvss2_integrity_impact string, "
    "cvss2_availability_impact string, cvss2_base_score double, "
    "cvss3_vector_string string, cvss3_attack_vector string, cvss3_attack_complexity string, "
    "cvss3_privileges_required string, cvss3_user_interaction string, cvss3_scope string, "
    "cvss3_confidentiality_impact string, cvss3_integrity_impact string, cvss3_availability_impact string, "
    "cvss3_base_score double, cvss3_base_severity string, "
    "exploitability_score double, impact_score double, ac_insuf_info boolean, "
    f"reference_json {REFERENCES}, problemtype_json {PROBLEM_TYPES}"
)
FIXES = ("cve_id string, hash string, repo_url string")
COMMITS = (
    "hash string, repo_url string, author string, author_date timestamp, author_timezone int, "
    "committer string, committer_date timestamp, committer_timezone int, msg string, merge boolean, "
    "parents array<string>, num_lines_added int, num_lines_deleted int, "
    "dmm_unit_complexity double, dmm_unit_interfacing double, dmm_unit_size double"
)
FILE_CHANGE = (
    "file_change_id bigint, hash string, filename string, old_path string, new_path string, "
    f"change_type string, diff string, diff_parsed {PARSED_DIFF}, num_lines_added int, num_lines_deleted int, "
    "code_after string, code_before string, nloc int, complexity int, token_count int, programming_language string"
)
METHOD_CHANGE = (
    "method_change_id bigint, file_change_id bigint, name string, signature string, parameters array<string>, "
    "start_line int, end_line int, code string, nloc int, complexity int, token_count int, "
    "top_nesting_level int, before_change boolean"
)
CWE = (
    "cwe_id string, cwe_name string, description string, extended_description string, url string, is_category boolean"
)
CWE_CLASSIFICATION = ("cve_id string, cwe_id string")
REPOSITORY = (
    "repo_url string, repo_name string, description string, date_created timestamp, date_last_push timestamp, "
    "homepage string, repo_language string, owner string, forks_count int, stars_count int"
)

TABLES = {
    "cve": CVE, "fixes": FIXES, "commits": COMMITS, "file_change": FILE_CHANGE, "method_change": METHOD_CHANGE,
    "cwe": CWE, "cwe_classification": CWE_CLASSIFICATION, "repository": REPOSITORY,
}

_CVSS2 = (
    "version:string,vectorString:string,accessVector:string,accessComplexity:string,authentication:string,"
    "confidentialityImpact:string,integrityImpact:string,availabilityImpact:string,baseScore:double"
)
_CVSS3 = (
    "version:string,vectorString:string,attackVector:string,attackComplexity:string,privilegesRequired:string,"
    "userInteraction:string,scope:string,confidentialityImpact:string,integrityImpact:string,"
    "availabilityImpact:string,baseScore:double,baseSeverity:string"
)
FEED_ITEM = (
    "struct<cve:struct<data_type:string,data_format:string,data_version:string,"
    "CVE_data_meta:struct<ID:string,ASSIGNER:string>,"
    f"problemtype:struct<problemtype_data:{PROBLEM_TYPES}>,"
    f"references:struct<reference_data:{REFERENCES}>,"
    f"description:struct<description_data:{LANG_TEXT}>>,"
    f"configurations:struct<CVE_data_version:string,nodes:{NODES}>,"
    f"impact:struct<baseMetricV3:struct<cvssV3:struct<{_CVSS3}>,exploitabilityScore:double,impactScore:double>,"
    f"baseMetricV2:struct<cvssV2:struct<{_CVSS2}>,severity:string,exploitabilityScore:double,impactScore:double,"
    "acInsufInfo:boolean,obtainAllPrivilege:boolean,obtainUserPrivilege:boolean,obtainOtherPrivilege:boolean,"
    "userInteractionRequired:boolean>>,publishedDate:string,lastModifiedDate:string>"
)
FEED = (
    "CVE_data_type string, CVE_data_format string, CVE_data_version string, CVE_data_numberOfCVEs string, "
    f"CVE_data_timestamp string, CVE_Items array<{FEED_ITEM}>"
)

# A commit with everything under it, as an exporter of repository histories writes it.
_METHOD = (
    "struct<name:string,long_name:string,parameters:array<string>,start_line:int,end_line:int,nloc:int,"
    "complexity:int,token_count:int,top_nesting_level:int>"
)
SNAPSHOT = (
    "hash string, repo_url string, author struct<name:string,date:timestamp,timezone:int>, "
    "committer struct<name:string,date:timestamp,timezone:int>, msg string, merge boolean, parents array<string>, "
    "modified_files array<struct<filename:string,old_path:string,new_path:string,change_type:string,diff:string,"
    f"diff_parsed:{PARSED_DIFF},source_code:string,source_code_before:string,nloc:int,complexity:int,"
    f"token_count:int,methods:array<{_METHOD}>,methods_before:array<{_METHOD}>>>"
)
PROBE_LOG = ("url string, probed_at timestamp, status int, location string")
