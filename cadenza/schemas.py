"""Types of the tables that the engine passes on, as DDL."""

LIMBS = ("lh", "rh", "lf", "rf")
STATES = ("4pt", "3pt", "2pt", "1pt", "idle")

POSE_FRAMES = "clip_id string, i int, t double, track_id int, bbox array<double>, kpts array<struct<x:double,y:double,c:double>>"
ANALYSIS_FRAMES = (
    "clip_id string, i int, t double, kpts array<struct<x:double,y:double>>, angles map<string,double>, com struct<x:double,y:double>, com_vel double, "
    "contacts struct<lh:boolean,rh:boolean,lf:boolean,rf:boolean>, n int, state string, st_t0 double, bd double, margin double, inside boolean, climbing boolean"
)
TRANSFER_EVENTS = "clip_id string, t0 double, t1 double, dur double, moved array<string>, dx double, dy double, disp double, s0 string, s1 string"
TECH_PHASES = "clip_id string, name string, t0 double, t1 double, side string, conf double"
TECH_EVENTS = "clip_id string, name string, t double, side string, conf double"
WORDS = "clip_id string, pos int, word string, start double, end double"
CAPTIONS = "clip_id string, k int, start double, end double, text string, terms array<struct<term:string,off:int>>"
SENTENCES = "clip_id string, k int, text string, ts array<array<bigint>>"
FIXES = "clip_id string, seq int, i int, text string"

#: COCO-17 joint order (fixed values).
JOINTS = ("nose", "leye", "reye", "lear", "rear", "lsho", "rsho", "lel", "rel", "lwr", "rwr", "lhip", "rhip", "lknee", "rknee", "lank", "rank")
KP = {n: i for i, n in enumerate(JOINTS)}
LIMB_JOINT = {"lh": "lwr", "rh": "rwr", "lf": "lank", "rf": "rank"}
LIMB_LABEL = {"lh": "左手", "rh": "右手", "lf": "左脚", "rf": "右脚"}
