"""Declared schemas. Times are seconds as doubles; operators compare them as whole microseconds."""

from __future__ import annotations

from pyspark.sql import types as T

WORD = "struct<word:string,start_s:double,end_s:double,confidence:double>"
LANGUAGES = "code string, name string, tier string, bcp47 string, script string, nllb_code string, fine_tuned_checkpoint string"
AUDIO_FILES = "path string, duration_s double, sample_rate int, channels int, format string, file_size_bytes long, error string"
CHUNKS = "recording_id string, chunk_id int, start_s double, end_s double, duration_s double"
BLOCKS = "recording_id string, block_no int, start_sample long, sample_rate int, samples array<float>, error string"
SEGMENTS = f"recording_id string, pos int, segment_id int, start_s double, end_s double, text string, language string, confidence double, words array<{WORD}>"
TURNS = "recording_id string, turn_no int, speaker_id string, start_s double, end_s double"
REGIONS = "recording_id string, pos int, start_s double, end_s double"
NON_SPEECH = "recording_id string, start_s double, end_s double, region_type string, duration_s double"
PROCESSED = (
    f"recording_id string, pos int, segment_id int, start_s double, end_s double, speaker_id string, language string, raw_text string, "
    f"corrected_text string, english_translation string, refined_translation string, confidence double, words array<{WORD}>, "
    "source_file string, absolute_start timestamp_ntz, absolute_end timestamp_ntz"
)
FILE_METRICS = (
    "file_path string, mic_name string, folder_key string, duration_s double, snr_db double, clipped_samples long, clipping_ratio double, "
    "plosive_spike_count int, spectral_rolloff_hz double, effective_bandwidth_hz double, crosstalk_ratio double, peak_amplitude double, "
    "rms_dbfs double, speech_ratio double"
)
SPEAKER_METRICS = (
    "folder string, filename string, mic string, speaker_id string, role string, talk_time_s double, n_turns int, avg_turn_s double, snr_db double, "
    "clip_pct double, plosives int, rolloff_hz double, bandwidth_hz double, crosstalk double, rms_dbfs double, quality_flag string, comment string"
)
PAIRS = "src string, subsource string, id string, ipa string, noisy string, bengali string, english string"
SCORES = "system string, metric string, cer double, wer double, ref_chars long, hyp_chars long"
MODEL_RUNS = "model_id string, audio_file string, transcript string, elapsed_s double, error string, translation string, translation_elapsed_s double"
TRANSCRIPT = f"metadata struct<audio_file:string,duration_s:double,languages_detected:array<string>>, segments array<struct<segment_id:int,start_s:double,end_s:double,speaker_id:string,language:string,raw_text:string,corrected_text:string,text:string,words:array<{WORD}>>>"


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)
