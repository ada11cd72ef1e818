"""Synthetic conversations: answers that admit what is unknown, and answers made from reference entries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.messages import fingerprint, pair
from quern.functions.text import clean, seeded_key
from quern.operators.dedup import keep_first

# Questions and answers with fields to fill in.
TEMPLATES = [
    (
        'Unity에서 {api} 어떻게 써?',
        "질문만으로는 정확히 답하기 어렵습니다. '{api}' 가 어떤 네임스페이스/클래스의 멤버인지, 그리고 무엇을 하려는지(예: 입력 처리, 물리, UI)를 알려주시면 Unity 2022.3 기준으로 공식 API에 근거해 정확히 안내하겠습니다. 확인되지 않은 시그니처를 추측해서 답하지 않겠습니다.",
    ),
    (
        '{system} 만드는 중인데 {api} 에러 나요. 왜 안 돼?',
        "{system} 관련 코드와 에러 메시지가 없어서 '{api}' 사용 맥락을 단정할 수 없습니다. 문제가 되는 코드 블록, 콘솔 에러 전문, Unity 버전(2022.3.x 권장)을 함께 주시면 재현 후 정확히 진단하겠습니다.",
    ),
    (
        '{api} 의 최신 시그니처가 뭐야?',
        "제가 확신할 수 없는 정확한 시그니처는 추측하지 않겠습니다. Unity 2022.3 Scripting API 문서에서 '{api}' 항목을 확인하시는 것을 권장합니다. 확인되면 해당 시그니처에 맞춰 예제를 작성해 드리겠습니다.",
    ),
    (
        '{legacy} 써서 {system} 짜줘',
        "'{legacy}' 는 Unity 2022.3에서 더 이상 권장되지 않거나 제거되었습니다. 추측으로 동작하는 척하기보다는, 현행 권장 API로 대체해 작성하는 것이 안전합니다. {system} 에서 어떤 동작을 원하시는지 알려주시면 2022.3에서 동작하는 현대적 방식으로 구현해 드리겠습니다.",
    ),
    (
        '{genre} 게임에서 {system} 어떻게 구현해?',
        "'{genre}' 라는 장르만으로는 '{system}' 의 요구사항을 특정하기 어렵습니다. 핵심 메커닉, 차원(2D/3D), 대상 플랫폼을 알려주시면 Unity 2022.3 기준으로 구조와 스크립트를 단계적으로 제안하겠습니다. 막연한 가정으로 코드를 지어내지는 않겠습니다.",
    ),
    (
        '{api} 와 {api2} 중에 뭐가 더 빨라?',
        "맥락 없이 '{api}' 와 '{api2}' 의 성능을 단정하긴 어렵습니다. 호출 빈도, 대상 플랫폼, 프로파일링 결과(예: Unity Profiler 의 CPU/GC 항목)를 알려주시면 측정 기반으로 비교해 드리겠습니다. 근거 없는 성능 단정은 피하겠습니다.",
    ),
    (
        '{system} 에서 {api} 쓰면 에러 나는데 고쳐줘',
        "에러 메시지 전문과 해당 코드가 없으면 '{api}' 사용 맥락을 정확히 파악할 수 없습니다. 스택트레이스, Unity 버전, 재현 단계를 주시면 {system} 맥락에 맞춰 진단하겠습니다.",
    ),
    (
        '{legacy} 가 deprecated 됐다는데 {system} 에선 뭘로 바꿔?',
        "'{legacy}' 는 Unity 2022.3 기준 권장되지 않습니다. 다만 '{system}' 에서의 정확한 대체 API는 원하시는 동작에 따라 달라지므로, 무엇을 하려는지 알려주시면 공식 문서에 근거한 현행 대체안을 제시하겠습니다.",
    ),
]
# What the fields are filled with.
FIELDS = {
    "api": [
        'DoThing()',
        'Foo.Bar',
        'GetComponentMagic',
        'Auto-everything',
        'MakeItWork',
        'SuperMove()',
        'FastUpdate',
        'Thing.Process',
        'GameManager.Run',
        'Helper.Fix',
        'Entity.Spawn',
        'Player.DoMagic',
        'World.Tick',
        'Net.Sync',
        'Save.All',
        'AI.Decide',
        'Pool.Grab',
        'UI.Refresh',
        'Audio.PlayMagic',
        'Cam.Track',
    ],
    "legacy": [
        'Application.LoadLevel',
        'WWW',
        'NetworkView',
        'GUIText',
        'ParticleEmitter',
        'OnLevelWasLoaded',
        'rigidbody.velocity',
        'Application.CaptureScreenshot',
        'GUITexture',
        'DestroyObject',
        'NetworkServer',
        'iPhoneSettings',
        'GameObject.SetActiveRecursively',
        'Application.RegisterLogCallback',
        'GUILayer',
    ],
    "system": [
        '인벤토리 시스템',
        '이동 컨트롤러',
        '세이브/로드',
        '적 AI',
        'UI 매니저',
        '오디오 매니저',
        '오브젝트 풀링',
        '대화 시스템',
        '퀘스트 시스템',
        '카메라 추적',
        '스킬 시스템',
        '상점 시스템',
        '스폰 매니저',
        '씬 전환',
        '입력 시스템',
        '체력바 UI',
        '미니맵',
        '업적 시스템',
        '튜토리얼',
        '네트워크 동기화',
    ],
    "genre": [
        '아무',
        '재밌는',
        'RPG',
        '플랫포머',
        '슈팅',
        '퍼즐',
        '오픈월드',
        '로그라이크',
        '타워디펜스',
        '리듬',
        '생존',
        '방치형',
        '레이싱',
        '디펜스',
    ],
}
FIELDS["api2"] = FIELDS["api"]


def abstain_pool(spark: SparkSession) -> DataFrame:
    """Every template with every filling of its fields, unique by fingerprint: pos, messages, source. The product is a chain
    of explodes over the template's own lists, so nothing is built on the driver."""
    frames = []
    for t, (question, answer) in enumerate(TEMPLATES):
        used = [f for f in FIELDS if "{" + f + "}" in question + answer]
        df = spark.range(1).select(F.lit(t).alias("t"))
        user, assistant = F.lit(question), F.lit(answer)
        for f in used:
            df = df.select("*", F.posexplode(F.array(*[F.lit(v) for v in FIELDS[f]])).alias(f"n_{f}", f))
            user, assistant = (F.replace(x, F.lit("{" + f + "}"), F.col(f)) for x in (user, assistant))
        place = F.concat(*[F.lpad(F.col(f"n_{f}").cast("string"), 3, "0") for f in used]) if used else F.lit("")
        frames.append(df.select(F.concat(F.lpad(F.lit(str(t)), 3, "0"), place).alias("pos"), pair(user, assistant).alias("messages"), F.lit("abstain").alias("source")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    out = out.withColumn("fp", fingerprint(F.col("messages")))
    return keep_first(out, "fp", F.col("pos")).drop("fp")


def abstain(spark: SparkSession, n: int, seed: int = 42) -> DataFrame:
    """n rows of the pool in seeded order; all of it if n is larger, none if it is negative."""
    return abstain_pool(spark).orderBy(seeded_key(seed, F.col("pos")), "pos").limit(max(int(n), 0))


def grounded_answers(entries: DataFrame, source: str = "hypersniper") -> DataFrame:
    """entries: member, summary, signature, example, url (any may be null), pos. Rows without a member or a summary go; answers say only
    what the entry says."""
    member, summary, signature, example, url = (clean(F.col(c)) for c in ("member", "summary", "signature", "example", "url"))
    # The wording of question and answer.
    question = F.concat(F.lit("Unity 2022.3에서 "), member, F.lit(" 는 무엇을 하나요? 사용법을 알려주세요."))
    answer = F.concat(
        summary,
        F.when(signature != "", F.concat(F.lit("\n시그니처:\n```csharp\n"), signature, F.lit("\n```"))).otherwise(""),
        F.when(example != "", F.concat(F.lit("\n예시:\n```csharp\n"), example, F.lit("\n```"))).otherwise(""),
        F.when(url != "", F.concat(F.lit("\n근거(공식 문서): "), url)).otherwise(""),
    )
    return entries.filter((member != "") & (summary != "")).select("pos", pair(question, answer).alias("messages"), F.lit(source).alias("source"))
