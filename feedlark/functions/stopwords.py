"""Stop-word profiles.

The profiles differ on purpose: the `social` list drops negations and the `review` list keeps
them, so the same sentence cleans differently depending on where it came from. No list is derived
from another.
"""

# The five lists below decide results and must not be edited.

SOCIAL = """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself
    she her hers herself it its itself they them their theirs themselves what which who whom
    this that these those am is are was were be been being have has had having do does did doing
    a an the and but if or because as until while of at by for with through during before after
    above below up down in out on off over under again further then once here there when where
    why how all any both each few more most other some such no nor not only own same so than too
    very s t can will just don should now
""".split()

PRODUCT = """
    the a an and or but in on at to for of with by is are was were be been being have has had do
    does did will would could should may might must can this that these those i you he she it we
    they me him her us them my your his her its our their am from up about into through during
    before after above below out off over under again further then once
""".split()

REVIEW = """
    the a an and or but in on at to for of with by is are was were be been being have has had do
    does did will would could should may might must can this that these those i you he she it we
    they me him her us them my your his her its our their
""".split()

MAPPING = """
    a an and are as at be by for from has he in is it its of on that the to was will with i me
    my myself we our ours ourselves you your yours yourself yourselves him his himself she her
    hers herself they them their theirs themselves what which who whom this these those am been
    being have had having do does did doing would should could ought can might must shall may
    need dare if or because as until while about against between into through during before
    after above below up down out off over under again further then once
""".split()

# The public English list of 318 words.
ENGLISH318 = """
    a about above across after afterwards again against all almost alone along already also
    although always am among amongst amoungst amount an and another any anyhow anyone anything
    anyway anywhere are around as at back be became because become becomes becoming been before
    beforehand behind being below beside besides between beyond bill both bottom but by call can
    cannot cant co con could couldnt cry de describe detail do done down due during each eg
    eight either eleven else elsewhere empty enough etc even ever every everyone everything
    everywhere except few fifteen fifty fill find fire first five for former formerly forty
    found four from front full further get give go had has hasnt have he hence her here
    hereafter hereby herein hereupon hers herself him himself his how however hundred i ie if in
    inc indeed interest into is it its itself keep last latter latterly least less ltd made many
    may me meanwhile might mill mine more moreover most mostly move much must my myself name
    namely neither never nevertheless next nine no nobody none noone nor not nothing now nowhere
    of off often on once one only onto or other others otherwise our ours ourselves out over own
    part per perhaps please put rather re same see seem seemed seeming seems serious several she
    should show side since sincere six sixty so some somehow someone something sometime
    sometimes somewhere still such system take ten than that the their them themselves then
    thence there thereafter thereby therefore therein thereupon these they thick thin third this
    those though three through throughout thru thus to together too top toward towards twelve
    twenty two un under until up upon us very via was we well were what whatever when whence
    whenever where whereafter whereas whereby wherein whereupon wherever whether which while
    whither who whoever whole whom whose why will with within without would yet you your yours
    yourself yourselves
""".split()

# profile -> (stop words, shortest token kept)
PROFILES = {
    "social": (SOCIAL, 2),
    "product": (PRODUCT, 2),
    "review": (REVIEW, 2),
    "mapping": (MAPPING, 3),
    "english318": (ENGLISH318, 2),
}
