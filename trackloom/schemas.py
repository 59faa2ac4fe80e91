"""Table schemas."""

ROBOT = (
    "struct<raw_id:bigint,stable_id:bigint,role:string,x:double,y:double,theta:double,vx:double,vy:double,omega:double,"
    "ax:double,ay:double,visibility:double>"
)
BALL = "struct<x:double,y:double,z:double,vx:double,vy:double,ax:double,ay:double,visibility:double>"
REFEREE = (
    "struct<stage:int,command:int,blue_team_on_positive_half:boolean,match_type:int,yellow_name:string,blue_name:string,"
    "yellow_score:bigint,blue_score:bigint>"
)
FLAGS = (
    "struct<duplicate_timestamp:boolean,carried_ball:boolean,out_of_bounds_objects:bigint,missing_target_robot_slots:bigint,"
    "likely_identity_swap:boolean,referee_live:boolean,heuristic_live:boolean>"
)
FRAMES_RAW = (
    f"game_id string, msg_pos bigint, source_name string, timestamp_s double, frame_number bigint, ball {BALL}, yellow array<{ROBOT}>, blue array<{ROBOT}>"
)
FRAMES = (
    f"game_id string, frame_pos bigint, timestamp_s double, frame_number bigint, ball {BALL}, target_team array<{ROBOT}>, opponent_team array<{ROBOT}>, "
    f"referee {REFEREE}, live boolean, target_attacks_positive_x boolean, sequence_kind string, flags {FLAGS}"
)
REVIEWS = "game_id string, sequence_index bigint, verdict string, note string"
VERDICTS = ("Keep", "Drop", "NeedsAttention", "Unreviewed")
PHASES = ("Group", "Elimination", "Friendly", "Unknown")
