"""Declared schemas of nested JSON payloads: nothing is inferred from data.

Field names are those of the message formats (fixed values).
"""

from __future__ import annotations

RULE_RESULT = "struct<id:string,cfg:string,wght:bigint,indpdntVarbl:double,subRuleRef:string,prcgTm:bigint,tenantId:string>"
TYPOLOGY_RESULT = f"struct<id:string,cfg:string,result:int,review:boolean,prcgTm:bigint,tenantId:string,workflow:struct<flowProcessor:string,alertThreshold:int,interdictionThreshold:int>,ruleResults:array<{RULE_RESULT}>>"
TADP_RESULT = f"struct<id:string,cfg:string,prcgTm:bigint,typologyResult:array<{TYPOLOGY_RESULT}>>"
ALERT_DATA = f"struct<status:string,timestamp:string,evaluationID:string,metaData:struct<prcgTmDP:bigint,prcgTmED:bigint>,tadpResult:{TADP_RESULT}>"

MONEY = "struct<Amt:double,Ccy:string>"
SMALL_MONEY = "struct<amt:double,ccy:string>"
AGENT = "struct<FinInstnId:struct<ClrSysMmbId:struct<MmbId:string>>>"
CHARGE = f"struct<Amt:{MONEY},Agt:{AGENT}>"
DATA_CACHE = f"struct<cdtrId:string,dbtrId:string,creDtTm:string,instdAmt:{SMALL_MONEY},xchgRate:double,cdtrAcctId:string,dbtrAcctId:string,intrBkSttlmAmt:{SMALL_MONEY}>"
STATUS = (
    f"struct<TxTp:string,TenantId:string,FIToFIPmtSts:struct<GrpHdr:struct<MsgId:string,CreDtTm:string>,TxInfAndSts:struct<TxSts:string,AccptncDtTm:string,OrgnlInstrId:string,OrgnlEndToEndId:string,"
    f"StsRsnInf:struct<Rsn:struct<Cd:string>>,InstgAgt:{AGENT},InstdAgt:{AGENT},ChrgsInf:array<{CHARGE}>,OrgnlTxRef:struct<Amt:struct<InstdAmt:{MONEY},EqvtAmt:{MONEY}>>>>,DataCache:{DATA_CACHE}>"
)
PARTY = "struct<Nm:string,Id:struct<PrvtId:struct<DtAndPlcOfBirth:struct<BirthDt:string>,Othr:array<struct<Id:string>>>>>"
ACCOUNT = "struct<Id:struct<Othr:array<struct<Id:string,SchmeNm:struct<Prtry:string>>>>>"
PAYMENT = (
    f"struct<TxTp:string,TenantId:string,FIToFICstmrCdtTrf:struct<GrpHdr:struct<MsgId:string,CreDtTm:string,NbOfTxs:int,SttlmInf:struct<SttlmMtd:string>>,CdtTrfTxInf:struct<PmtId:struct<InstrId:string,EndToEndId:string>,"
    f"Purp:struct<Cd:string>,ChrgBr:string,InstdAmt:struct<Amt:{MONEY}>,IntrBkSttlmAmt:struct<Amt:{MONEY}>,XchgRate:double,CdtrAgt:{AGENT},DbtrAgt:{AGENT},Cdtr:{PARTY},Dbtr:{PARTY},CdtrAcct:{ACCOUNT},DbtrAcct:{ACCOUNT},ChrgsInf:{CHARGE}>,"
    f"RmtInf:struct<Ustrd:string>>,DataCache:{DATA_CACHE}>"
)
NETWORK_MAP = "struct<cfg:string,active:boolean,tenantId:string,messages:array<struct<id:string,cfg:string,txTp:string,typologies:array<struct<id:string,cfg:string,rules:array<struct<id:string,cfg:string>>>>>>>"
CONDITION = (
    "struct<condId:string,tenantId:string,usr:string,acct:struct<id:string,schmeNm:struct<prtry:string>,agt:struct<finInstnId:struct<clrSysMmbId:struct<mmbId:string>>>>,ntty:struct<id:string,schmeNm:struct<prtry:string>>,"
    "condTp:string,prsptv:string,condRsn:string,forceCret:boolean,creDtTm:string,incptnDtTm:string,xprtnDtTm:string,evtTp:array<string>>"
)
RULE = (
    "struct<id:string,cfg:string,desc:string,tenantId:string,creDtTm:string,updDtTm:string,config:struct<parameters:struct<tolerance:double,maxQueryRange:bigint>,bands:array<struct<subRuleRef:string,reason:string,lowerLimit:double,upperLimit:double>>,"
    "exitConditions:array<struct<subRuleRef:string,reason:string>>,cases:struct<alternative:struct<subRuleRef:string,reason:string>,expressions:array<struct<subRuleRef:string,reason:string,value:string>>>>>"
)
TYPOLOGY = "struct<id:string,cfg:string,typology_name:string,desc:string,workflow:struct<flowProcessor:string,alertThreshold:int,interdictionThreshold:int>,rules:array<struct<id:string,cfg:string,termId:string,wghts:array<struct<ref:string,wght:double>>>>,expression:array<string>>"
EVALUATION = f"struct<report:struct<timestamp:string,evaluationID:string,status:string,metaData:struct<prcgTmDP:bigint,prcgTmED:bigint>,tadpResult:{TADP_RESULT}>,dataCache:{DATA_CACHE},transaction:{STATUS}>"

PAYMENT_TYPES = ("pacs.008.001.10", "pain.001.001.11")
STATUS_TYPE = "pacs.002.001.12"
OVERRIDE_RULE = "EFRuP@1.0.0"
