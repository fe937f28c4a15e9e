"""Input schemas of the claim tables. Ids are long, codes text, money decimal(18,2)."""

from __future__ import annotations

CLAIM = """ID bigint, ClaimNumber string, PolicyID bigint, LossType string, LOBCode string, LossCause string,
    LossDate timestamp, ReportedDate timestamp, CloseDate timestamp, State string, LitigationStatus string,
    SubrogationStatus string, SIUStatus string, SIScore double, Fault double, FaultRating string,
    JurisdictionState string, Ext_LossLocState string, LossLocationID bigint, LocationOfTheft string,
    Ext_LocationofLoss string, Ext_ResponsibleParty string, ClaimantDenormID bigint, InsuredDenormID bigint,
    ISOStatus string, Ext_MethodOfEntry string, SIULifeCycleState string, Description string"""
EXPOSURE = """ID bigint, ClaimID bigint, IncidentID bigint, CoverageID bigint, PrimaryCoverage string,
    CoverageSubType string, ExposureType string, LossParty string, ClaimantType string, ClaimantDenormID bigint"""
EXPOSURE_REPORT = """exposureid bigint, RemainingReserves decimal(18,2), TotalPayments decimal(18,2),
    TotalRecoveries decimal(18,2), FuturePayments decimal(18,2), OpenReserves decimal(18,2)"""
POLICY = """ID bigint, PolicyNumber string, EffectiveDate timestamp, OrigEffectiveDate timestamp,
    ExpirationDate timestamp, PolicyType string, TotalVehicles int, Ext_CustomerNumber string,
    ext_broadlobcode string, Ext_UWrtSubLOBCodes string"""
INCIDENT = """ID bigint, ClaimID bigint, VehicleID bigint, VehicleType string, VehicleDriveable int,
    Ext_EntireSideDamaged int, VehicleParked int, TotalLoss int, Ext_LowImpactIncident int, Collision int,
    Ext_RearEndCollision int, Speed double"""
VEHICLE = "ID bigint, Make string, Model string, Vin string, Year int"
CONTACT = """ID bigint, Name string, FirstName string, LastName string, DateOfBirth date, Gender string,
    Occupation string, PrimaryAddressID bigint"""
ADDRESS = "ID bigint, AddressLine1 string, City string, PostalCode string, State string, County string"
BODY_PART = "IncidentID bigint, PrimaryBodyPart string"
MATCH_REPORT = "ClaimID bigint, MatchReasons string"
CONTRIBUTING_FACTOR = "ClaimID bigint, PriContributingFactors string"
RESERVE_LINE = """ClaimID bigint, Ext_ITDCreditToExpenseRecovery decimal(18,2),
    Ext_ITDCreditToLossRecovery decimal(18,2), Ext_ITDDeductibleRecovery decimal(18,2), Ext_ITDPaid decimal(18,2),
    Ext_ITDRecovered decimal(18,2), Ext_ITDSalvageRecovery decimal(18,2), Ext_ITDSubrogationRecovery decimal(18,2)"""
TRANSACTION = """ClaimNumber string, IssueDate timestamp, TransactionAmount decimal(18,2),
    TransactionType string"""
NOTE = "ClaimID bigint, AuthoringDate timestamp, Body string"
CODE_TABLE = "ID string, DESCRIPTION string"
COVERAGE_MAP = "PrimaryCoverage string, exposuretype_desc string, cov_rollup_3 string, line int"
STATE_MAP = "lossloc_State string, STATE_ABBR string, REGION string, DIVISION string"
