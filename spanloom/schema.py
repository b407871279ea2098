"""Types of the records that are read and written."""

from __future__ import annotations

WORD = "struct<word:string,start:double,end:double,probability:double>"
SEGMENT = f"struct<id:int,start:double,end:double,text:string,avg_logprob:double,no_speech_prob:double,words:array<{WORD}>>"
TRANSCRIPT = f"schema_version string, surah string, surah_order int, episode int, source_audio string, transcribed_at string, model string, language string, language_probability double, duration_seconds double, segments array<{SEGMENT}>"
VERSE = "verse_id int, surah_no int, surah_name string, ayah_no int, text_uthmani string, text_norm string, uth_align array<int>"
CORPUS_XML = "_index int, _name string, aya array<struct<_index:int,_text:string>>"
CATALOGUE = "generated_at string, total_videos int, videos array<struct<filename:string,surah:string,surah_order:int,episode:int,is_intro:boolean,path:string>>"
ORDERS = "surahs array<struct<order:int,name:string>>"
GOLD = "episode string, surah string, ayah int, status string, confidence double, start double, end double, transcript_text string, canonical_quoted string, VERDICT string, NOTE string"
MATCH = "struct<surah:string,surah_no:int,ayah:int,ayah_end:int,verse_id:int,canonical_text:string,canonical_quoted:string,confidence:double,status:string,start:double,end:double,word_start:int,word_end:int,transcript_text:string,fuzz_score:double,coverage:double,is_cross_surah:boolean,chain_id:int>"
ENRICHED = f"schema_version string, surah string, surah_order int, episode int, source_transcript string, primary_surah_no int, total_matches int, accepted int, review int, cross_surah int, matches array<{MATCH}>, segments array<struct<id:int,start:double,end:double,text:string,enriched_text:string,matches:array<{MATCH}>>>"
MANIFEST = "phase string, updated_at string, counts struct<total:int,done:int,failed:int,pending:int>, records map<string,struct<status:string,output_path:string,error:string,processed_at:string>>"
