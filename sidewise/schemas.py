"""Schemas of the raw JSON documents.

Leaf values are declared STRING and cast afterwards: a document is parsed once,
a bad leaf then either fails the strict cast or becomes NULL under the lenient
one, and it never spoils the neighbouring fields.
"""

from __future__ import annotations

TEAM = "struct<id:string,name:string,slug:string,shortName:string,nameCode:string>"
SCORE = "struct<current:string,period1:string,period2:string>"
COUNTRY = "struct<name:string,alpha2:string,alpha3:string>"
TOURNAMENT = (
    "struct<id:string,name:string,slug:string,uniqueTournament:struct<id:string>,"
    f"category:struct<country:{COUNTRY}>>"
)
MATCH_FIELDS = (
    "id:string,slug:string,customId:string,startTimestamp:string,"
    "status:struct<code:string,type:string,description:string>,winnerCode:string,"
    f"homeScore:{SCORE},awayScore:{SCORE},homeTeam:{TEAM},awayTeam:{TEAM},"
    f"tournament:{TOURNAMENT},season:struct<id:string,name:string,year:string>,"
    "roundInfo:struct<round:string,name:string>,"
    "time:struct<injuryTime2:string,currentPeriodStartTimestamp:string>,"
    "isEditor:string,feedLocked:string,finalResultOnly:string,hasGlobalHighlights:string,"
    "venue:struct<stadium:struct<name:string>>,"
    "_metadata:struct<source:string,batch_id:string,ingestion_timestamp:string>"
)
MATCH = f"struct<{MATCH_FIELDS}>"

# Key and name come first: items sort by them as they are.
STAT_ITEM = (
    "struct<key:string,name:string,home:string,away:string,homeValue:string,awayValue:string,"
    "compareCode:string,statisticsType:string,valueType:string,renderType:string>"
)
STAT_PERIODS = (
    f"array<struct<period:string,groups:array<struct<groupName:string,statisticsItems:array<{STAT_ITEM}>>>>>"
)
# The same list of periods is stored either bare or inside one more object.
STATS_BARE = f"struct<statistics:{STAT_PERIODS}>"
STATS_WRAPPED = f"struct<statistics:struct<statistics:{STAT_PERIODS}>>"
# The bare form with a field that is filled where anything in the document is not as declared.
UNFIT = "_corrupt_record"
STATS_BARE_CHECKED = f"struct<statistics:{STAT_PERIODS},{UNFIT}:string>"

UPCOMING = (
    f"struct<data:struct<events:array<{MATCH}>,hasNextPage:string>,"
    "metadata:struct<tournament_id:string,season_id:string,extraction_date:string,"
    "extracted_at:string,page_index:string,source:string,api_endpoint:string>>"
)
