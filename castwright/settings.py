"""Run settings: plain driver-side arguments with the reference's defaults and checks.

They become literal columns in the plans; nothing here is read from the process environment.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Mapping

# Provider names and defaults of the reference configuration.
PROVIDER_POLLY = "polly"
PROVIDER_ELEVENLABS = "elevenlabs"
PROVIDERS = (PROVIDER_POLLY, PROVIDER_ELEVENLABS)
DEFAULT_POLLY_VOICE = "Joanna"
DEFAULT_ELEVENLABS_VOICE = "JBFqnCBsd6RMkjVDRZzb"
DEFAULT_ELEVENLABS_MODEL = "eleven_multilingual_v2"
DEFAULT_ELEVENLABS_FORMAT = "mp3_44100_128"
DEFAULT_STYLE = "podcast"
DEFAULT_SCRIPT_MODE = "single"
SCRIPT_MODES = ("single", "duo")


class SettingsError(ValueError):
    pass


@dataclass(frozen=True)
class Settings:
    bucket: str = "podcast-artifacts"
    region: str = "us-east-1"
    model_id: str = "anthropic.claude-3-haiku-20240307-v1:0"
    tts_provider: str = PROVIDER_POLLY
    polly_voice_id: str = DEFAULT_POLLY_VOICE
    polly_duo_voice_id: str = DEFAULT_POLLY_VOICE
    elevenlabs_api_key: str | None = None
    elevenlabs_voice_id: str = DEFAULT_ELEVENLABS_VOICE
    elevenlabs_duo_voice_id: str = DEFAULT_ELEVENLABS_VOICE
    elevenlabs_model_id: str = DEFAULT_ELEVENLABS_MODEL
    elevenlabs_output_format: str = DEFAULT_ELEVENLABS_FORMAT

    @property
    def default_voices(self) -> tuple[str, str]:
        if self.tts_provider == PROVIDER_ELEVENLABS:
            return self.elevenlabs_voice_id, self.elevenlabs_duo_voice_id
        return self.polly_voice_id, self.polly_duo_voice_id

    @property
    def has_api_key(self) -> bool:
        return bool(self.elevenlabs_api_key)


def settings_from(values: Mapping[str, str | None]) -> Settings:
    """Build settings from named values with the same defaults and checks as the reference
    (bucket and model id required, provider one of two, voices and model fields non-blank)."""

    def get(name: str, default: str | None = None) -> str | None:
        v = values.get(name)
        return default if v is None else v

    bucket = get("bucket")
    if not bucket:
        raise SettingsError("Missing required setting: bucket")
    model_id = get("model_id")
    if not model_id:
        raise SettingsError("Missing required setting: model_id")
    provider = (get("tts_provider", PROVIDER_POLLY) or PROVIDER_POLLY).strip().lower()
    if provider not in PROVIDERS:
        raise SettingsError("tts_provider must be either 'polly' or 'elevenlabs'")
    polly_voice = (get("polly_voice_id", DEFAULT_POLLY_VOICE) or "").strip()
    polly_duo = (get("polly_duo_voice_id", polly_voice or DEFAULT_POLLY_VOICE) or "").strip()
    key = (get("elevenlabs_api_key") or "").strip() or None
    el_voice = (get("elevenlabs_voice_id", DEFAULT_ELEVENLABS_VOICE) or "").strip()
    el_duo = (get("elevenlabs_duo_voice_id", el_voice or DEFAULT_ELEVENLABS_VOICE) or "").strip()
    el_model = (get("elevenlabs_model_id", DEFAULT_ELEVENLABS_MODEL) or "").strip()
    el_format = (get("elevenlabs_output_format", DEFAULT_ELEVENLABS_FORMAT) or "").strip()
    for name, value in (("polly_voice_id", polly_voice), ("polly_duo_voice_id", polly_duo)):
        if not value:
            raise SettingsError(f"{name} must not be empty")
    if provider == PROVIDER_ELEVENLABS and not key:
        raise SettingsError("Missing required setting: elevenlabs_api_key")
    for name, value in (("elevenlabs_voice_id", el_voice), ("elevenlabs_duo_voice_id", el_duo),
                        ("elevenlabs_model_id", el_model), ("elevenlabs_output_format", el_format)):
        if not value:
            raise SettingsError(f"{name} must not be empty")
    return Settings(
        bucket=bucket, region=get("region", "us-east-1") or "us-east-1", model_id=model_id,
        tts_provider=provider, polly_voice_id=polly_voice, polly_duo_voice_id=polly_duo,
        elevenlabs_api_key=key, elevenlabs_voice_id=el_voice, elevenlabs_duo_voice_id=el_duo,
        elevenlabs_model_id=el_model, elevenlabs_output_format=el_format,
    )
